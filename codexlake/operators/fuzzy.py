"""Matching candidate headwords to expected ones.

The ratio is 200 * LCS / (sum of lengths). Pairs come from an equi-join on
length: a candidate is written once for each length its match may have at the
cutoff, so no cross join is needed and no pair above the cutoff is lost; the
number of common letters bounds the ratio before it is computed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit for each letter of a."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & places.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def ratio_column(a: Column, b: Column) -> Column:
    from pyspark.sql.types import DoubleType

    @F.arrow_udf(DoubleType())
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array(np.array([ratio(p or "", q or "") for p, q in zip(x.to_pylist(), y.to_pylist(), strict=True)], float))

    return run(a, b)


def shared_letters(a: Column, b: Column) -> Column:
    """An upper bound of the LCS: letters of a left after b's are taken away,
    counted by sorted letters with their occurrence."""
    def marked(x: Column) -> Column:
        letters = F.array_sort(F.split(x, ""))
        return F.transform(letters, lambda c, i: F.concat(c, F.lit("/"), (i - F.array_position(letters, c)).cast("string")))

    return F.size(F.array_intersect(marked(a), marked(b)))


def fuzzy_pairs(candidates: DataFrame, expected: DataFrame, cutoff: float) -> DataFrame:
    """(candidate, canonical, score) of all pairs at the cutoff or above."""
    t = float(cutoff)
    n = F.length("candidate")
    c = candidates.select("candidate").distinct().filter(n > 0).withColumn("n", F.explode(F.sequence(F.ceil(n * (t / (200 - t)) - 1e-9).cast("int"), F.floor(n * ((200 - t) / t) + 1e-9).cast("int"))))
    e = expected.select("canonical").distinct().withColumn("n", F.length("canonical"))
    pairs = c.join(e, "n").filter(200 * shared_letters(F.col("candidate"), F.col("canonical")) >= t * (F.length("candidate") + F.length("canonical")))
    return pairs.select("candidate", "canonical", ratio_column(F.col("candidate"), F.col("canonical")).alias("score")).filter(F.col("score") >= t)


def best_match(candidates: DataFrame, expected: DataFrame, cutoff: float) -> DataFrame:
    """The best canonical form of each candidate; ties by name."""
    return fuzzy_pairs(candidates, expected, cutoff).groupBy("candidate").agg(F.max_by("canonical", F.struct("score", F.transform(F.split("canonical", ""), lambda ch: -F.ascii(ch)))).alias("canonical"), F.max("score").alias("score"))


def exact_matches(candidates: DataFrame, expected: DataFrame) -> DataFrame:
    return candidates.join(expected.select(F.col("canonical").alias("candidate")).distinct(), "candidate", "left_semi")


def learn_variations(parsed: DataFrame, expected: DataFrame, cutoff: float = 80) -> DataFrame:
    """Unknown parsed headwords with a near, not equal, expected one."""
    unknown = parsed.join(expected.select(F.col("canonical").alias("candidate")), "candidate", "left_anti")
    return best_match(unknown, expected, cutoff).filter("score < 100").withColumnRenamed("candidate", "variant")


def variation_matches(candidates: DataFrame, variations: DataFrame) -> DataFrame:
    return candidates.join(variations.select(F.col("variant").alias("candidate"), "canonical"), "candidate")


def by_priority(exact: DataFrame, variation: DataFrame, fuzzy: DataFrame, place: str = "pos") -> DataFrame:
    """One match for each place: exact before variation before fuzzy."""
    out = None
    for rank, (kind, df) in enumerate((("exact", exact), ("variation", variation), ("fuzzy", fuzzy))):
        df = df.withColumn("match_type", F.lit(kind)).withColumn("rank", F.lit(rank))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.withColumn("rn", F.row_number().over(Window.partitionBy(place).orderBy("rank", "candidate"))).filter("rn = 1").drop("rn", "rank")


def substitutions(pairs: DataFrame) -> DataFrame:
    """Letters read for others in pairs (variant, canonical) of one length."""
    diff = F.filter(F.zip_with(F.split("variant", ""), F.split("canonical", ""), lambda a, b: F.struct(b.alias("letter"), a.alias("read_as"))), lambda x: x["letter"] != x["read_as"])
    return pairs.filter(F.length("variant") == F.length("canonical")).select(F.explode(diff).alias("d")).groupBy("d.letter", "d.read_as").agg(F.count(F.lit(1)).alias("n"))
