"""Look-alike domains against a long list of trusted domains.

A nested loop would compare every domain with every trusted one.  Here a trusted domain is
cut into k + 2 pieces, where k is the most edits any similar domain can need (Li, Deng, Wang,
Feng: Pass-Join, PVLDB 2011).  k edits touch at most k pieces, so at least two pieces survive
in a similar domain.  The piece that is most frequent among all trusted domains, typically the
ending, is left out of the index: one of the others survives still, and no index key is shared
by a large part of the list.  Candidates agree on a piece and are verified inside the join.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import similarity
from .keyed import first_per_key


def trusted_frame(spark, domains) -> DataFrame:
    """A (pos, domain) table of a configured list."""
    return spark.createDataFrame(list(enumerate(domains)), "pos int, domain string")


def _most_edits(length):
    """Most edits between a domain of ``length`` bytes and any domain similar to it."""
    return f"cast(floor(3 * floor(20 * {length} / 17) / 20) as int)"


# Piece i of n pieces of a domain of length `len` starts (0-based) at i * len div n.
_PIECES = """
    transform(sequence(0, k + 1), i -> struct(
        cast(i as int) as piece,
        substring(raw, cast(i * len div (k + 2) as int) + 1,
                  cast((i + 1) * len div (k + 2) - i * len div (k + 2) as int)) as part))
"""
# What a domain must hold at or near the same place, for each trusted length in reach that exists.
# With a length difference d, a piece that is moved by s needs s edits before it and d - s after
# it, so only moves with |s| + |d - s| <= k can be part of a similar domain.
_PROBES = f"""
    flatten(transform(filter(lengths, l -> l between ceil(17 * len / 20) and floor(20 * len / 17)),
      l -> flatten(transform(sequence(0, {_most_edits('l')} + 1),
        i -> transform(filter(sequence(-{_most_edits('l')}, {_most_edits('l')}),
                              s -> abs(s) + abs(len - l - s) <= {_most_edits('l')}),
          s -> struct(
            cast(l as int) as tlen, cast(i as int) as piece,
            case when cast(i * l div ({_most_edits('l')} + 2) as int) + s >= 0 then
              substring(raw, cast(i * l div ({_most_edits('l')} + 2) as int) + s + 1,
                cast((i + 1) * l div ({_most_edits('l')} + 2)
                     - i * l div ({_most_edits('l')} + 2) as int)) end as part,
            cast((i + 1) * l div ({_most_edits('l')} + 2)
                 - i * l div ({_most_edits('l')} + 2) as int) as size))))))
"""


def _index(trusted: DataFrame) -> DataFrame:
    """(tlen, piece, part) keys of the trusted domains, the commonest piece of each left out."""
    pieces = (trusted.select("pos", F.col("domain").alias("trusted"),
                             similarity.as_bytes("domain").alias("raw"))
              .withColumn("len", F.length("raw"))
              .withColumn("k", F.expr(_most_edits("len")))
              .filter("k >= 1 and len >= k + 2")
              .select("pos", "trusted", F.col("len").alias("tlen"), F.expr(f"inline({_PIECES})")))
    common = pieces.groupBy("tlen", "piece", "part").agg(F.count("*").alias("freq"))
    counted = pieces.join(common, ["tlen", "piece", "part"])
    left_out = first_per_key(counted, ("pos", "trusted"),
                             (F.col("freq").desc(), F.col("piece").desc()))
    return pieces.join(left_out.select("pos", "trusted", "piece"),
                       ["pos", "trusted", "piece"], "left_anti")


def similar_domains(domains: DataFrame, trusted: DataFrame) -> DataFrame:
    """All (domain, pos, trusted, similarity) with similarity inside the open window.

    ``domains`` has one column ``domain``; ``trusted`` has (pos, domain).
    """
    index = _index(trusted)
    # Domains have at most 253 bytes, so this is a short list.
    lengths = index.agg(F.coalesce(F.collect_set("tlen"), F.array().cast("array<int>"))).scalar()
    probes = (domains.select("domain", similarity.as_bytes("domain").alias("raw"))
              .withColumn("len", F.length("raw"))
              .filter("len >= 6").withColumn("lengths", lengths)
              .select("domain", F.explode(F.array_distinct(F.expr(_PROBES))).alias("p"))
              .select("domain", "p.*")
              .filter("part is not null and length(part) = size").drop("size"))
    longest = F.greatest(F.octet_length("domain"), F.octet_length("trusted"))
    percent = similarity.similarity(similarity.byte_distance("domain", "trusted"), longest)
    return (probes.join(index, ["tlen", "piece", "part"])
            .filter((F.col("domain") != F.col("trusted"))
                    & similarity.lengths_allow(F.octet_length("domain"), F.octet_length("trusted")))
            .withColumn("similarity", percent)
            .filter(similarity.in_window("similarity"))
            .select("domain", "pos", "trusted", "similarity").distinct())


def first_match(domains: DataFrame, trusted: DataFrame) -> DataFrame:
    """Per domain the match with the smallest position."""
    return (similar_domains(domains, trusted).groupBy("domain")
            .agg(F.min(F.struct("pos", "trusted", "similarity")).alias("m"))
            .select("domain", "m.pos", "m.trusted", "m.similarity"))


def with_lookalike(messages: DataFrame, domains: DataFrame, trusted: DataFrame,
                   name: str) -> DataFrame:
    """Add the first match of the sender's domain; ``domains`` has the senders' domains.

    Domains are made distinct before they are compared.  Adaptive execution broadcasts the matches
    if they are few; otherwise the slim rows are shuffled, and it splits the domains that very
    many messages come from.
    """
    distinct = domains.filter("domain != ''").distinct()
    matches = first_match(distinct, trusted).select(F.col("domain").alias("_sender_domain"),
                             F.struct("trusted", "similarity").alias(name))
    return messages.join(matches, "_sender_domain", "left")
