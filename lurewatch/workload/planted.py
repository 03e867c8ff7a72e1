"""Values planted into the test mail that is derived from the generated tables."""

SENDERS = (
    "leo@outer-mail.org", "billing@companyy.com", "help@micr0soft.com",
    "help@micorsoft.com", "desk@paypol.com", "nina@company.com", "omar@elsewhere.net",
    "news@microsoft.com", "no-address", "one@two@three.com", "Desk@MICR0SOFT.com",
    "info@micrоsoft.com",   # the o is Cyrillic
    "ops@eu.company.com",
)
NAMES = ("CEO Rita Lund", "Omar Haddad", "Nils Berg, CFO", "billing desk",
         "Vice President, Sales", "Marceo Rossi", "")
PHRASES = (
    "Urgent matter: have the wire transfer sent off immediately, the supplier is waiting",
    "Cake in the kitchen at four",
    "The invoice of March is open: arrange payment by wire transfer, it is urgent",
    "Get four gift card codes for iTunes before lunch today, asap, says the CEO",
    "Il me faut un bulletin de paie et un bulletin de salaire par personne",
    "Urgent: can we talk today",
    "Invoice payment pay",
    "Un virement bancaire prioritaire pour ce dossier",
    "The payroll export is ready",
    "Notes of the weekly round",
    "confidential private sensitive approved authorized between us pay urgent",
    "urgent ceo president director approved authorized confidential",
)
ROLES = ("CEO", "Software Engineer", "CFO", "HR Director", "Finance Manager", "Coordinator",
         "DRH", "Comptable", "", "Président Directeur Général", "Budget Analyst",
         "Talent Partner", "Engineer")
ATTACHMENTS = (
    None, ("scan.pdf.exe",), ("notes.v1.pdf",), ("form.doc",), ("list.pdf", "run.js"),
    ("plan.docx",), ("a.doc", "b.tar.gz"), (), None, None, None, ("photo.png",),
    None, None, None, ("late.xlsm",), None,
)
SPF = (None, "pass", "softfail", "Fail (not authorized)", "pass")
AUTH = (None, "spf=fail dkim=pass dmarc=pass", "dkim=fail dmarc=pass", "DKIM=FAIL; DMARC=FAIL",
        None, "dkim=pass dmarc=fail", None)
REPLY = (None, "", "drop@gmail.com", "info@firm-office.com", "Chief <chief@gmail.com>",
         "DROP@Yahoo.com", None, None, None, None, None)
