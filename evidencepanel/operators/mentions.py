"""Which names of a large dimension stand in which texts, by an index of their beginnings.

Every name is filed under its first characters (at most three) with its length, so names
that begin alike and are as long share one entry.  A text meets the index on its distinct
grams; where an entry calls, the text gives just the pieces of that length which begin so,
and a piece is a name or not: one equality join decides.  Pieces grow with the places in
texts where some name could begin, whatever many names begin there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidencepanel.operators.groups import need, never_broadcast, same_key
from evidencepanel.plans.session import written_once

GRAM_CHARS = 3


def _grams(text: Column, size: int) -> Column:
    """All runs of ``size`` characters, overlapping ones too."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=({'.' * size}))"), F.lit(1))


def _pieces(text: Column, start: Column, length: Column) -> Column:
    """The distinct runs of ``length`` characters that begin with ``start``, overlapping ones too."""
    quoted = F.concat(F.lit("\\Q"), F.replace(start, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    rest = (length - F.length(start)).cast("string")
    return F.array_distinct(F.regexp_extract_all(text, F.concat(F.lit("(?s)(?=("), quoted, F.lit(".{"), rest, F.lit("}))")), F.lit(1)))


def name_index(names: DataFrame, name: str, size: int = GRAM_CHARS) -> DataFrame:
    """``_g, _n``: the distinct beginnings of names with the lengths they have; blank names are left out."""
    listed = names.select(F.col(name).alias("_name")).where(F.length("_name") > 0)
    return listed.select(F.substring("_name", 1, size).alias("_g"), F.length("_name").alias("_n")).distinct()


def mentions(texts: DataFrame, key: str, text: str, names: DataFrame, name: str = "short", size: int = GRAM_CHARS) -> DataFrame:
    """``key, name``: each distinct name that a text holds, once per text.

    ``key`` tells texts apart; null texts hold no names.  Names are looked for as written, also
    inside longer words.  Both tables may be of any size.  A place in a text gives at most one
    piece for every length of the names that begin like it.
    """
    need(texts, key, text)
    need(names, name)
    given = texts.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    cuts = F.array_distinct(F.concat(*[_grams(F.col("_t"), n) for n in range(1, size + 1)]))
    probes = given.select("_k", F.explode(cuts).alias("_p"))
    # Written, its size is known: where it is small, the many probes are not exchanged.
    index = written_once(name_index(names, name, size), "name-index")
    called = probes.join(index, probes["_p"] == index["_g"]).select("_k", "_g", "_n")
    met = called.join(never_broadcast(given.withColumnRenamed("_k", "_id")), same_key([(F.col("_k"), F.col("_id"))]))
    pieces = met.select("_k", F.explode(_pieces(F.col("_t"), F.col("_g"), F.col("_n"))).alias("_piece"))
    listed = names.select(F.col(name).alias("_name")).where(F.length("_name") > 0).distinct()
    found = pieces.join(never_broadcast(listed), same_key([(pieces["_piece"], listed["_name"])]))
    return found.select(F.col("_k").alias(key), F.col("_name").alias(name))
