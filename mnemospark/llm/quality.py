"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

For each text some statistics are counted and transformed. Per (lang, source) the minimum
covariance determinant estimate of their centre and scatter is found by concentration steps: start
from the diagonal of robust spreads, keep the share ``SUPPORT`` of rows with the smallest
Mahalanobis distances, estimate again. Rows whose final squared distance exceeds ``CUTOFF`` are
rejected.

Everything is DataFrame expressions. Quantiles come from counts on a fixed grid, so that a group is
never gathered, however large: every step is a sum per group, combined before the shuffle. Groups
below ``SMALL_GROUP`` rows take the estimate of their language, small languages that of all rows.

Null and empty texts have no words and fail the limits. Null ``lang`` or ``source`` is a group of
its own. Equal rows get equal verdicts. Result columns replace input columns of the same name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from mnemospark.llm.staging import SPACES, WORD, stage

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50  # fixed values of the limits
SYMBOLS = r"[#*$%&|<>]"  # fixed value
SUPPORT = 0.75  # share of a group's rows that the estimate rests on
STEPS = 3  # concentration steps
SMALL_GROUP = 200
CUTOFF = 60.0  # squared distance beyond which a text is an outlier; the chi-square tail there is below 1e-10
#: Smallest standard deviation of each statistic. Most are constant in clean prose, so that their scatter matrix alone
#: would be singular; these also say how far a text must stray to matter.
FLOORS = {"mean_length": 0.12, "symbol_rate": 0.02, "line_repeats": 0.08, "word_repeats": 0.08, "shouting": 0.05, "marks": 0.05}
GRID = 16  # steps of the quantile grid per doubling of the distance
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def counts(docs: DataFrame, text_col: str = "text", prefix: str = "_q_") -> DataFrame:
    """``docs`` with the counts of ``STATS`` and those of the other statistics, as ``prefix`` columns."""
    p = lambda name: F.col(prefix + name)
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn(prefix + "words", F.regexp_extract_all(text, F.lit(f"({WORD})"), 1))
    n = F.size(p("words"))
    hashes = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
        F.get(p("words"), i), F.get(p("words"), i + 1), F.get(p("words"), i + 2)))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACES}]"))
    df = df.select("*", n.cast("long").alias(prefix + "n_words"), hashes.alias(prefix + "grams"), lines.alias(prefix + "lines"),
                   F.length(F.array_join(p("words"), "")).cast("long").alias(prefix + "word_chars"),
                   F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias(prefix + "n_symbols"),
                   F.regexp_count(text, F.lit(r"[\p{Lu}]{2}")).cast("long").alias(prefix + "n_shouts"),
                   F.regexp_count(text, F.lit("[!?]")).cast("long").alias(prefix + "n_marks")).drop(prefix + "words")
    n_grams = F.size(p("grams"))
    # Positions of windows, by window: only texts with a repeated window are sorted.
    ordered = F.when(F.size(F.array_distinct(p("grams"))) < n_grams, F.sort_array(F.transform(p("grams"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.select("*", ordered.alias(prefix + "ordered"),
                   (F.size(p("lines")) - F.size(F.array_distinct(p("lines")))).cast("long").alias(prefix + "n_dup_lines")).drop(prefix + "lines", prefix + "grams")
    same = lambda x, other: F.coalesce(F.get(p("ordered"), other)["h"] == x["h"], F.lit(False))
    found = F.filter(p("ordered"), lambda x, j: same(x, j + 1) | F.when(j > 0, same(x, j - 1)).otherwise(False))
    df = df.withColumn(prefix + "at", F.sort_array(F.transform(found, lambda x: x["i"]))).drop(prefix + "ordered")
    # A window adds three words, fewer where the next one begins inside it.
    covered = F.aggregate(p("at"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")), lambda acc, i: F.struct(
        (acc["n"] + F.least(F.lit(3), i - acc["last"])).cast("long").alias("n"), i.alias("last")))["n"]
    return df.withColumn(prefix + "n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop(prefix + "at")


def statistics(prefix: str) -> dict[str, Column]:
    """The transformed statistics; every one is near normal or constant in clean prose."""
    c = lambda name: F.col(prefix + name).cast("double")
    n = F.greatest(c("n_words"), F.lit(1.0))
    return {
        "mean_length": F.log1p(c("word_chars") / n), "symbol_rate": F.log1p(c("n_symbols") / n),
        "line_repeats": F.log1p(c("n_dup_lines") / F.sqrt(n)), "word_repeats": c("n_repeat_words") / n,
        "shouting": F.log1p(c("n_shouts") / n), "marks": F.log1p(c("n_marks") / n),
    }


def distance(x: list[Column], mean: list[Column], scatter: list[list[Column]]) -> Column:
    """Squared Mahalanobis distance by forward substitution with the Cholesky factor's columns."""
    z: list[Column] = []
    for i in range(len(x)):
        z.append((x[i] - mean[i] - reduce(lambda a, b: a + b, [scatter[i][j] * z[j] for j in range(i)], F.lit(0.0))) / scatter[i][i])
    return reduce(lambda a, b: a + b, [v * v for v in z])


def _levels(df: DataFrame) -> DataFrame:
    """Each row once for its group, once for its language, once for all rows."""
    level = lambda n, lang, source: F.struct(F.lit(n).alias("level"), lang.alias("lang"), source.alias("source"))
    none = F.lit(None).cast("string")
    return df.withColumn("g", F.explode(F.array(level(0, F.col("lang"), F.col("source")), level(1, F.col("lang"), none), level(2, none, none))))


def _factor(df: DataFrame, names: list[str]) -> DataFrame:
    """Mean ``m0..`` and Cholesky factor ``l00..`` from sums per group; ``FLOORS`` on the diagonal."""
    d = len(names)
    cov = [[F.col(f"p{i}_{j}") / F.col("n") - F.col(f"s{i}") / F.col("n") * F.col(f"s{j}") / F.col("n") for j in range(i + 1)] for i in range(d)]
    df = df.select("g", "n", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(d)],
                   *[(cov[i][j] + (FLOORS[names[i]] ** 2 if i == j else 0.0)).alias(f"c{i}_{j}") for i in range(d) for j in range(i + 1)])
    for i in range(d):  # column by column: each needs the ones before
        for j in range(i + 1):
            rest = F.col(f"c{i}_{j}") - reduce(lambda a, b: a + b, [F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)], F.lit(0.0))
            df = df.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(rest, F.lit(FLOORS[names[i]] ** 2 / 4))) if i == j else rest / F.col(f"l{j}_{j}"))
    return df.drop(*[f"c{i}_{j}" for i in range(d) for j in range(i + 1)])


def _apply(rows: DataFrame, model: DataFrame, names: list[str]) -> DataFrame:
    """Squared distance of each row to its group's estimate. The model has a row per group."""
    d = len(names)
    joined = rows.join(model, F.col("g").eqNullSafe(F.col("mg")), "left")
    d2 = distance([F.col(n) for n in names], [F.col(f"m{i}") for i in range(d)], [[F.col(f"l{i}_{j}") if j <= i else None for j in range(d)] for i in range(d)])
    return joined.withColumn("d2", d2)


def _threshold(rows: DataFrame, value: str, share: float) -> DataFrame:
    """Per group the upper edge of the grid cell in which the wanted share of rows is reached."""
    from pyspark.sql import Window
    cell = F.floor(F.log2(F.col(value) + F.lit(1e-6)) * GRID).cast("int")
    cells = rows.groupBy("g", cell.alias("cell")).count()
    w = Window.partitionBy("g").orderBy("cell")
    return (cells.withColumn("upto", F.sum("count").over(w)).withColumn("total", F.sum("count").over(Window.partitionBy("g")))
            .where(F.col("upto") >= F.ceil(F.col("total") * share)).groupBy("g").agg(F.min("cell").alias("cut"))
            .select(F.col("g").alias("tg"), "cut"))


def _sums(rows: DataFrame, names: list[str]) -> DataFrame:
    d = range(len(names))
    return rows.groupBy("g").agg(F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(names[i]).alias(f"s{i}") for i in d],
                                 *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p{i}_{j}") for i in d for j in range(i + 1)])


def estimate(stats: DataFrame, names: list[str]) -> DataFrame:
    """Minimum-covariance-determinant estimates: one row ``mg, m*, l*`` for each group, language and all."""
    rows = _levels(stats)
    d = range(len(names))
    # Start: component-wise medians, from the grid of each statistic, and the floors as scatter.
    long = rows.select(F.col("g").alias("og"), F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(n).alias("v")) for i, n in enumerate(names)])).alias("e"))
    medians = _threshold(long.select(F.struct("og", "e.i").alias("g"), F.col("e.v").alias("v")), "v", 0.5)
    start = medians.groupBy(F.col("tg.og").alias("mg")).agg(
        *[F.max(F.when(F.col("tg.i") == i, F.pow(F.lit(2.0), (F.col("cut") + 0.5) / GRID) - 1e-6)).alias(f"m{i}") for i in d])
    model = stage(start.select("mg", *[f"m{i}" for i in d], *[F.lit(FLOORS[names[i]] if i == j else 0.0).alias(f"l{i}_{j}") for i in d for j in range(i + 1)]), "quality")
    for _ in range(STEPS):
        near = _apply(rows, model, names)
        cuts = _threshold(near, "d2", SUPPORT)
        cell = F.floor(F.log2(F.col("d2") + F.lit(1e-6)) * GRID).cast("int")
        kept = near.join(cuts, F.col("g").eqNullSafe(F.col("tg"))).where(cell <= F.col("cut"))
        model = stage(_factor(_sums(kept, names), names).withColumnRenamed("g", "mg"), "quality")
    return model


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", key: str = "doc_id") -> DataFrame:
    """A row per row of ``docs``: key, ``STATS``, ``base_failed``, ``d2`` and ``kept``.

    Rows that fail the limits take no part in the estimates.
    """
    counted = counts(docs.select(F.col(key), F.col(text_col).alias("_q_text"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source")), "_q_text")
    failed = (F.col("_q_n_words") < MIN_WORDS) | (100 * F.col("_q_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_q_n_words"))
    transformed = statistics("_q_")
    names = list(transformed)
    stats = stage(counted.select(key, "lang", "source", *[F.col("_q_" + s).alias(s) for s in STATS], failed.alias("base_failed"),
                                 *[v.alias(k) for k, v in transformed.items()]), "quality")
    model = estimate(stats.where(~F.col("base_failed")), names)
    sizes = stats.where(~F.col("base_failed")).groupBy("lang", "source").count()
    by_lang = sizes.groupBy("lang").agg(F.sum("count").alias("lang_count"))
    # The level whose estimate each (lang, source) uses.
    use = (sizes.join(by_lang.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")))
           .select(F.col("lang").alias("ul"), F.col("source").alias("us"),
                   F.when(F.col("count") >= SMALL_GROUP, 0).when(F.col("lang_count") >= SMALL_GROUP, 1).otherwise(2).alias("level")))
    g = F.struct(F.col("level"), F.when(F.col("level") < 2, F.col("lang")).alias("lang"), F.when(F.col("level") < 1, F.col("source")).alias("source"))
    rows = stats.join(use, F.col("lang").eqNullSafe(F.col("ul")) & F.col("source").eqNullSafe(F.col("us")), "left").withColumn("g", g)
    return _apply(rows, model, names).select(key, *STATS, "base_failed", F.col("d2"),
                                             (~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= CUTOFF)).alias("kept"))
