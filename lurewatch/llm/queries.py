"""The registered queries of the operators, and their SQL."""

from pyspark.sql import functions as F

from . import (alignment, backoff_lm, chat, collocations, exact_dedup, html_wrappers, licenses, mixing, near_dedup,
               packing, suffix_dedup, topk, toxicity)
from .common import table


def op1_suffix_dedup(spark, d):
    return suffix_dedup.remove_repeats(table(spark, d, "documents"), keep_text=False).drop("kept")


def op2_chat_format(spark, d):
    turns = chat.canonical_rows(table(spark, d, "conversations"))
    said = F.lit("\\### Assistant: </turn> ok")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    out = chat.format_rows(turns.unionByName(planted))
    out = out.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn(
        "loss_text", chat.loss_text(F.col("formatted"), F.col("loss")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op5_html_extract(spark, d):
    return html_wrappers.main_text(table(spark, d, "pages"))


def op6_topk(spark, d):
    return topk.top_k(table(spark, d, "embeddings"), lambda c: c % 50 == 0, 5)


def op7_exact_dedup(spark, d):
    return exact_dedup.decisions(table(spark, d, "documents")).drop("r")


# Parameters of the mix: integer weights per level; sources not named weigh 1.
MIX = {"budget_share": 0.6, "seed": 17, "domain_weights": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
       "lang_weights": {"en": 5, "de": 2, "fr": 2, "es": 1}, "source_weights": {"src0": 2, "src5": 3}}


def op8_mixing(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    got = mixing.mixed(docs, mixing.numbered_domain(F.col("source")), epochs=2, **MIX)
    return got.select("row.doc_id", "mix_domain", "row.lang", "row.source", F.col("mix_epoch").cast("long").alias("epoch"),
                      F.col("mix_tokens").alias("tokens"))


def op9_packing(spark, d, vocabulary=None):
    return packing.pack_documents(table(spark, d, "documents"), vocabulary or vocabulary_path(),
                                  added=added_tokens()).drop("ids")


def op10_near_dedup(spark, d):
    return near_dedup.classes(table(spark, d, "documents")).drop("r")


def op3_license_scan(spark, d):
    got = licenses.scan(table(spark, d, "documents"))
    return got.withColumn("licenses", F.array_join("licenses", ", "))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def toxicity_model(spark, d, docs):
    rows = toxicity.training_rows(table(spark, d, "labels"), docs, lambda c: ~held_out(c))
    return toxicity.fit(rows)


def op4_toxicity(spark, d):
    docs = table(spark, d, "documents")
    got = toxicity.score(docs, toxicity_model(spark, d, docs))
    return got.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def vocabulary_path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens():
    """The tokens that the tokenizer has beside the vocabulary's ranks."""
    import public_tokenizers
    return packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))


def lm_training(doc_id):
    """Documents that the language model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 != 2, F.lit(True))


def op11_lm_score(spark, d):
    return backoff_lm.score(table(spark, d, "documents"), lm_training(F.col("doc_id")))


def op12_collocations(spark, d):
    return collocations.mine(table(spark, d, "documents"))


def op13_alignment(spark, d):
    import public_tokenizers
    got = alignment.align(table(spark, d, "documents"), vocabulary_path(), public_tokenizers.path("piece_bpe_32k.model"),
                          keep_groups=False)
    return got.withColumnRenamed("groups", "groups_sha256")


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup, "op2_chat_format": op2_chat_format, "op3_license_scan": op3_license_scan,
           "op4_toxicity": op4_toxicity, "op5_html_extract": op5_html_extract, "op6_topk": op6_topk, "op7_exact_dedup": op7_exact_dedup,
           "op8_mixing": op8_mixing, "op9_packing": op9_packing,
           "op10_near_dedup": op10_near_dedup,
           "op11_lm_score": op11_lm_score,
           "op12_collocations": op12_collocations, "op13_alignment": op13_alignment}

_ESC = "replace(replace(replace({0}, '\\', '\\s'), '<', '\\l'), '>', '\\g')"

ORACLE = {
    "op1_suffix_dedup": """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS place,
                  hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, place, i, substr(h, 2 * i + 1, 100) AS s
      FROM (SELECT r, place, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)),
f AS (SELECT s, min(place) AS place FROM w GROUP BY s),
hit AS (SELECT w.r, w.i, lag(w.i) OVER (PARTITION BY w.r ORDER BY w.i) AS prev FROM w JOIN f ON w.s = f.s AND w.place > f.place),
g AS (SELECT r, i, sum(CASE WHEN prev IS NULL OR i > prev + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM hit),
span AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY r, run),
part AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS x, a AS y FROM span
         UNION ALL SELECT r, max(b), 2000000000 FROM span GROUP BY r),
kept AS (SELECT d.r, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS h FROM d JOIN part ON d.r = part.r GROUP BY d.r),
n AS (SELECT r, count(*) AS spans, sum(b - a) AS removed FROM span GROUP BY r)
SELECT doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept ON d.r = kept.r LEFT JOIN n ON d.r = n.r""",
    "op2_chat_format": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                  FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<turn:' || {_ESC.format('role')} || '>' || {_ESC.format('text')} || '</turn>') + 1) AS BIGINT)
    AS formatted_chars
FROM t GROUP BY conv_id""",
    "op6_topk": """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
         row_number() OVER () AS r
  FROM embeddings
  WHERE embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding,
        lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))), true)),
s AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v),
         lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT) AS score
  FROM e q JOIN e c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, coalesce(score, 0) AS score FROM k WHERE n <= 5""",
    "op7_exact_dedup": """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
w AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER p AS keep_id, row_number() OVER p AS place
  FROM t WINDOW p AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM w""",
    "op12_collocations": r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM t GROUP BY lang),
g AS (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, list_slice(w, i, i + k - 1) AS w
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM t, (SELECT unnest(range(1, 6)) AS k))),
f AS (SELECT lang, k, phrase, any_value(w) AS w, count(*) AS a FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT f.lang, f.phrase, f.a, j, array_to_string(list_slice(f.w, 1, j), ' ') AS head,
             array_to_string(list_slice(f.w, j + 1, f.k), ' ') AS tail
      FROM f, (SELECT unnest(range(1, 5)) AS j) WHERE j < f.k),
s AS (SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, total.n,
        CAST((1000::HUGEINT * c.a * total.n) // (l.a::HUGEINT * r.a) AS BIGINT) AS score, c.j
      FROM c JOIN f l ON l.lang = c.lang AND l.phrase = c.head JOIN f r ON r.lang = c.lang AND r.phrase = c.tail
      JOIN total ON total.lang = c.lang),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM s) x WHERE o = 1
      AND NOT EXISTS (SELECT 1 FROM f y WHERE y.lang = x.lang AND y.a >= x.a AND len(y.phrase) > len(x.phrase)
                      AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' '))),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM z WHERE rank <= 2000""",
    "op8_mixing": """
WITH d AS (
  SELECT doc_id, lang, source, coalesce(lang, '?') AS l, coalesce(source, '?') AS s,
    CASE WHEN regexp_extract(source, '(\\d{1,9})$', 1) = '' OR source IS NULL THEN 'other'
         ELSE 'domain' || CAST(CAST(regexp_extract(source, '(\\d{1,9})$', 1) AS BIGINT) % 4 AS VARCHAR) END AS dom,
    CAST(coalesce((strlen(text) + 3) // 4, 0) AS BIGINT) AS tokens FROM documents),
leaf AS (SELECT dom, l, s, sum(tokens) AS tokens, 2 * sum(tokens) AS cap,
    CASE s WHEN 'src0' THEN 2 WHEN 'src5' THEN 3 ELSE 1 END AS w FROM d GROUP BY dom, l, s),
lng AS (SELECT dom, l, sum(cap) AS cap, CASE l WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w
    FROM leaf GROUP BY dom, l),
dm AS (SELECT dom, sum(cap) AS cap, CASE dom WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2
    ELSE 1 END AS w FROM lng GROUP BY dom),
d1 AS (SELECT *, (SELECT sum(tokens) FROM leaf) * 600 // 1000 AS b,
    coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb,
    sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wr
    FROM dm WINDOW o AS (ORDER BY cap / w, dom)),
d2 AS (SELECT *, cap * wr <= (b - cb) * w AS f FROM d1),
da AS (SELECT dom, CASE WHEN f THEN cap ELSE least(cap, (b - coalesce(sum(CASE WHEN f THEN cap END) OVER (), 0)) * w
    // sum(CASE WHEN f THEN 0 ELSE w END) OVER ()) END AS a FROM d2),
l1 AS (SELECT lng.*, da.a AS b,
    coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb,
    sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wr
    FROM lng JOIN da USING (dom) WINDOW o AS (PARTITION BY dom ORDER BY cap / w, l)),
l2 AS (SELECT *, cap * wr <= (b - cb) * w AS f FROM l1),
la AS (SELECT dom, l, CASE WHEN f THEN cap ELSE least(cap, (b - coalesce(sum(CASE WHEN f THEN cap END)
    OVER (PARTITION BY dom), 0)) * w // sum(CASE WHEN f THEN 0 ELSE w END) OVER (PARTITION BY dom)) END AS a FROM l2),
s1 AS (SELECT leaf.*, la.a AS b,
    coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb,
    sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wr
    FROM leaf JOIN la USING (dom, l) WINDOW o AS (PARTITION BY dom, l ORDER BY cap / w, s)),
s2 AS (SELECT *, cap * wr <= (b - cb) * w AS f FROM s1),
q AS (SELECT dom, l, s, tokens AS held, CAST(CASE WHEN f THEN cap ELSE least(cap, (b - coalesce(sum(CASE WHEN f THEN cap END)
    OVER (PARTITION BY dom, l), 0)) * w // sum(CASE WHEN f THEN 0 ELSE w END) OVER (PARTITION BY dom, l)) END AS BIGINT)
    AS quota FROM s2),
e AS (SELECT d.*, q.quota, epoch, CASE WHEN epoch < quota // held THEN held ELSE quota % held END AS room,
    md5('17:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '?')) AS place
    FROM d JOIN q USING (dom, l, s), (SELECT unnest(range(2)) AS epoch) WHERE quota > 0 AND epoch <= quota // held),
c AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY dom, l, s, epoch ORDER BY place, tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e)
SELECT doc_id, dom AS mix_domain, lang, source, CAST(epoch AS BIGINT) AS epoch, tokens
FROM c WHERE epoch < quota // CAST((SELECT held FROM q WHERE q.dom = c.dom AND q.l = c.l AND q.s = c.s) AS BIGINT)
   OR before < room""",
}
