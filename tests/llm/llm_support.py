"""Frames and comparisons for the corpus tests."""

import zlib

from compare import _rows, oracle_connection

from layerwell.llm.queries import QUERIES
from layerwell.llm.sql import ORACLES

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=""):
    """Documents from (doc_id, text, lang, source, ...); ``extra`` names further columns."""
    return spark.createDataFrame([(r[0], r[1], *r[2:4], len(r[1] or ""), *r[4:]) for r in rows], DOC + extra).repartition(3)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def held(doc_id, folds, rest):
    return zlib.crc32(str(doc_id).encode()) % folds == rest


def differs(spark, sf_dir, name):
    """None if a registered query equals its oracle."""
    cursor = oracle_connection(sf_dir).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, sf_dir)
    if sorted(df.columns) != sorted(columns):
        return f"{df.columns} != {columns}"
    got, want = _rows(df.columns, [tuple(r) for r in df.collect()]), _rows(columns, cursor.fetchall())
    return next((f"{g} != {w}" for g, w in zip(got, want) if g != w), None) or (None if len(got) == len(want) else "row count")
