"""Exact duplicates found with a two-pass Bloom filter.

Pass one hashes every text to two cells of a bit field and keeps the cells that
were hit more than once. Pass two looks each text up in that filter: a text whose
two cells are both marked may be repeated and is shuffled to its equals; all others
are certainly single and go straight through, without a shuffle.

The filter has 16 bits per row up to a fixed size (``common.filter_bits``), so it may
always be broadcast; beyond that size more rows take the shuffle, and no result changes.

Defined results: null text counts as empty; empty texts are equal to each other;
rows that repeat both text and doc_id are one document (``deduplicate`` keeps one row
of them, the report marks them alike); among equal texts a null doc_id is smallest;
an empty table gives an empty result; further columns are carried along unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwell.llm.common import ascii_lower, filter_bits, filter_words, packed, with_filter_hit
from layerwell.session import materialize

SALTS = 64


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased, as lowercase hex."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)


def _digests(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int]:
    """Digest table (doc_id, digest), the filter's words and its size; texts are read once."""
    digest = F.unhex(text_digest(F.col(text_col)))
    digests = materialize(docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest")), "digests")
    bits = filter_bits(digests.count())
    return digests, materialize(filter_words(digests, F.col("digest"), bits, least=2), "repeated"), bits


def duplicate_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Equal texts are counted per (digest, salt) first and then per digest, and each
    salted part gets the result of its group, so a group of any size is spread over
    ``SALTS`` tasks and its rows are never brought together.
    """
    digests, words, bits = _digests(docs, id_col, text_col)
    looked_up = with_filter_hit(digests, F.col("digest"), words, bits, "maybe")
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    single = looked_up.where("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha
    )
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    rows = looked_up.where("maybe").select("doc_id", "digest", salt.alias("salt"))
    parts = rows.groupBy("digest", "salt").agg(F.max("doc_id").alias("top"), F.count("*").alias("rows"))
    groups = (
        parts.groupBy("digest")
        .agg(F.max("top").alias("keep_id"), F.sum("rows").alias("group_size"), F.collect_list("salt").alias("salts"))
        .select("digest", "keep_id", "group_size", F.explode("salts").alias("salt"))
    )
    repeated = rows.join(groups, ["digest", "salt"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), sha
    )
    return single.unionByName(repeated)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without copies: of equal texts the row with the largest doc_id stays, whole.

    Possibly repeated rows are reduced in the map tasks, so of a large group one row
    per task is shuffled. Equal ids are decided by the remaining columns.
    """
    digests, words, bits = _digests(docs, id_col, text_col)
    rows = docs.select(packed(docs), F.unhex(text_digest(F.col(text_col))).alias("digest"))
    looked_up = with_filter_hit(rows, F.col("digest"), words, bits, "maybe")
    single = looked_up.where("not maybe").select("row.*")
    rank = F.struct(F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{text_col}`").alias("text"), F.to_json("row").alias("rest"))
    repeated = looked_up.where("maybe").groupBy("digest").agg(F.max_by("row", rank).alias("row")).select("row.*")
    return single.unionByName(repeated)
