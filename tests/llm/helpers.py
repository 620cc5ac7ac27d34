"""Odd rows that every operator must take, and plain versions of shared definitions."""

import re

from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "alpha beta gamma delta " * 20_000
#: null, empty and blank texts, a very long one, ties and a repeated row
ODD_TEXTS = [(900_001, None), (900_002, ""), (900_003, " \n\t "), (900_004, LONG), (900_005, "one two"), (900_006, "one  two"), (900_005, "one two"), (None, "no id here")]


def documents(spark, folder):
    """The folder's documents with odd rows and columns whose names operators use themselves."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame([(i, t, None, "src1" if t else None, None) for i, t in ODD_TEXTS], docs.schema)
    clashing = {name: F.lit("x") for name in ("size", "taken", "kept", "score", "rep", "group", "block", "length", "target", "_key")}
    return docs.unionByName(odd).withColumns(clashing)


def words(text):
    return WORDS.findall(text or "")
