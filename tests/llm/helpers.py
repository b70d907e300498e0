"""Small tables with the awkward rows every operator must take."""

import random

from pyspark.sql import functions as F

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "pe", "ri", "so", "tu", "va", "ze") for b in ("ban", "dor", "fel", "gim", "hup", "jas", "kel")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(n))


def edited(rng, text, share):
    words = text.split(" ")
    for k in rng.sample(range(len(words)), int(share * len(words))):
        words[k] = "edit" + str(rng.randrange(10**6))
    return " ".join(words)


def frame(spark, texts, schema="doc_id long, text string, lang string, source string, n_chars long"):
    """A documents table with columns that clash with names used inside the operators."""
    rows = [(i, t, "en" if i is None or i % 2 else "de", "src0", None if t is None else len(t)) for i, t in texts]
    df = spark.createDataFrame(rows, schema)
    for name in ("key", "rest", "rep", "value", "component", "row", "marks", "packed", "grp"):
        df = df.withColumn(name, F.lit(7))
    return df


def rng(seed=5):
    return random.Random(seed)
