"""Quality rules: word statistics per document and robust multivariate outliers.

Documents that pass the plain rules are compared with others of their language and
source: statistics are transformed to a vector, location and scatter are estimated by
the minimum covariance determinant, and documents whose Mahalanobis distance is too
large are rejected. Everything is DataFrame expressions; rows meet their pool's estimate
by (pool, salt), and sums combine before they are shuffled, so that a source with a third of
all rows is spread over many tasks. Each concentration step is one query: plans, exchanges and
their threads, not rows, are what the driver's memory goes to.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passagework.functions.arrays import let, with_once
from passagework.llm.common import texts
from passagework.session import written

WORD_SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
STEPS = 4
#: Share of a pool's documents that its estimate rests on.
CORE = 0.75
#: Pools with fewer documents are estimated with all of their language, or all together.
MIN_POOL = 200
SALTS = 64
#: Median of the chi-square distribution with as many degrees as ``VECTOR`` has parts.
CHI_MEDIAN = 4.351
#: Squared distances over this are outliers: what chi-square exceeds with probability 1e-6.
CUTOFF = 35.89
_BIN = 16  # bins of squared distances per factor of e

#: Transformed statistics, each with the least deviation it is judged by. That of the size is
#: a factor of two, as a long text is no worse than others; smaller ones of repeats and symbols
#: reject texts that are labelled as good (figures in the README).
VECTOR: dict[str, tuple[str, float]] = {
    "size": ("ln(n_words)", 0.7),
    "word": ("ln(word_chars / n_words)", 0.05),
    "symbols": ("log1p(100 * n_symbols / word_chars)", 0.2),
    "lines": ("log1p(20 * n_dup_lines / sqrt(n_words))", 0.3),
    "repeats": ("log1p(20 * n_repeat_words / n_words)", 0.3),
}
_P = list(VECTOR)
_PAIRS = [(i, j) for i in range(len(_P)) for j in range(i + 1)]


def _repeat_words(words: Column) -> Column:
    """Words covered by three-word windows whose words occur twice or more."""
    n = F.size(words)
    windows = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        starts = let(
            ordered,
            lambda o: F.sort_array(
                F.transform(
                    F.filter(
                        o,
                        lambda x, k: F.coalesce(F.get(o, k + 1)["h"] == x["h"], F.lit(False))
                        | ((k > 0) & F.coalesce(F.get(o, k - 1)["h"] == x["h"], F.lit(False))),
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        lengths = let(
            starts,
            lambda s: F.transform(
                s, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(s, k + 1) - x, F.lit(3)))
            ),
        )
        total = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)
        # most texts repeat nothing, and distinct hashes are cheaper than sorted ones
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), total)

    found = F.when(n >= 4, let(windows, covered))
    return F.coalesce(found, F.lit(0).cast("long"))


def text_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """Add the statistics of every whole text to the columns named; null texts have no words.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines
    with a word that equal an earlier line), ``n_repeat_words``, ``base_failed``, ``text_key``.
    """
    base = with_once(
        texts(docs, *keep), "words", F.array_remove(F.split("text", WORD_SPLIT), "")
    )
    joined = with_once(base, "joined", F.array_join("words", ""))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(F.translate(x, "\t\n\x0b\x0c\r", ""))) > 0)
    counted = with_once(joined, "lines", lines).select(
        *keep,
        F.xxhash64("text").alias("text_key"),
        F.size("words").cast("long").alias("n_words"),
        F.length("joined").cast("long").alias("word_chars"),
        (F.length("joined") - F.length(F.regexp_replace("joined", SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
    )
    few = F.col("n_words") < MIN_WORDS
    repeated = 100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    return counted.withColumn("base_failed", few | repeated)


def _salted(params: DataFrame) -> DataFrame:
    return params.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _factor(moments: DataFrame) -> DataFrame:
    """Location and Cholesky factor of each pool from moments about ``c0``.. (the old location)."""
    out = moments
    for i, name in enumerate(_P):
        out = out.withColumn(f"d{i}", F.col(f"s{i}") / F.col("n"))
        out = out.withColumn(f"m_{name}", F.col(f"c{i}") + F.col(f"d{i}"))
    for i, j in _PAIRS:  # one row a pool: sizes here are those of the pools
        spread = F.col(f"q{i}_{j}") / F.col("n") - F.col(f"d{i}") * F.col(f"d{j}")
        if i == j:
            spread = F.greatest(spread, F.lit(0.0)) + F.lit(VECTOR[_P[i]][1] ** 2)
        out = out.withColumn(f"v{i}_{j}", spread)
    for i in range(len(_P)):
        for j in range(i + 1):
            done = reduce(
                lambda a, k: a - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}"), range(j), F.col(f"v{i}_{j}")
            )
            cell = F.sqrt(F.greatest(done, F.lit(1e-9))) if i == j else done / F.col(f"l{j}_{j}")
            out = out.withColumn(f"l{i}_{j}", cell)
    return out.select("pool", *(f"m_{x}" for x in _P), *(f"l{i}_{j}" for i, j in _PAIRS))


def _distance(df: DataFrame) -> DataFrame:
    """Add ``d2``, the squared distance by forward substitution, and its bin."""
    for i, name in enumerate(_P):
        rest = reduce(
            lambda a, k: a - F.col(f"l{i}_{k}") * F.col(f"y{k}"),
            range(i),
            F.col(name) - F.col(f"m_{name}"),
        )
        df = df.withColumn(f"y{i}", rest / F.col(f"l{i}_{i}"))
    d2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(len(_P))), F.lit(0.0))
    return df.withColumn("d2", d2).withColumn("bin", F.floor(F.log(F.col("d2") + 1e-6) * _BIN))


def _limited(counts: DataFrame, share: float, name: str) -> DataFrame:
    """Add to (pool, bin, n, ..) the bin up to which ``share`` of the pool's rows lie; counted, not estimated."""
    by = Window.partitionBy("pool")
    upto = counts.withColumn("upto", F.sum("n").over(by.orderBy("bin"))).withColumn(
        "all", F.sum("n").over(by)
    )
    reached = F.when(F.col("upto") >= share * F.col("all"), F.col("bin"))
    return upto.withColumn(name, F.min(reached).over(by)).drop("upto", "all")


def _moments(measured: DataFrame, core: float) -> DataFrame:
    """Sums of each pool's nearest rows about its location, ``c0``..; one pass.

    Rows are summed by bin, and the bins within ``core`` of the rows then make the sums.
    """
    sums = {"n": F.lit(1)}
    sums |= {f"s{i}": F.col(x) - F.col(f"m_{x}") for i, x in enumerate(_P)}
    sums |= {f"q{i}_{j}": sums[f"s{i}"] * sums[f"s{j}"] for i, j in _PAIRS}
    # a pool's rows all have its location
    centres = [F.min(f"m_{x}").alias(f"c{i}") for i, x in enumerate(_P)]
    binned = measured.groupBy("pool", "bin").agg(*centres, *(F.sum(c).alias(n) for n, c in sums.items()))
    near = _limited(binned, core, "limit").where("bin <= limit")
    return near.groupBy("pool").agg(
        *(F.min(f"c{i}").alias(f"c{i}") for i in range(len(_P))), *(F.sum(n).alias(n) for n in sums)
    )


def _pools(stats: DataFrame) -> DataFrame:
    """Vectors of the documents to judge, each with the pool that judges it, all pools it is part of, and a salt.

    A pool that stands in for small ones is estimated from every document of the language,
    or of the table, not from those of the small ones alone.
    """
    salt = F.pmod(F.xxhash64("doc_id", "text_key", "n_words"), F.lit(SALTS)).cast("int")
    vectors = stats.where(~F.col("base_failed")).select(
        "doc_id", "text_key", "lang", "source", salt.alias("salt"), *(F.expr(c).alias(n) for n, (c, _) in VECTOR.items())
    )
    sizes = written(vectors.groupBy("lang", "source").agg(F.count("*").alias("n")), "pools")
    by_lang = sizes.groupBy(F.col("lang").alias("l")).agg(F.sum("n").alias("of_lang"), F.min("n").alias("least"))
    use_all = by_lang.where(F.col("of_lang") < MIN_POOL).count() > 0  # a number from a row per language
    own, of_lang = F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang"))
    large, spoken = F.col("n") >= MIN_POOL, F.col("of_lang") >= MIN_POOL
    named = sizes.join(by_lang, F.col("lang").eqNullSafe(F.col("l"))).select(
        "l",
        F.col("source").alias("s"),
        F.when(large, own).when(spoken, of_lang).otherwise("all").alias("pool"),
        F.array_compact(
            F.array(
                F.when(large, own),
                F.when(spoken & (F.col("least") < MIN_POOL), of_lang),
                F.when(F.lit(use_all), F.lit("all")),
            )
        ).alias("pools"),
    )
    named = _salted(written(named, "pools")).withColumnRenamed("salt", "t")
    return vectors.join(
        named,
        F.col("lang").eqNullSafe(F.col("l"))
        & F.col("source").eqNullSafe(F.col("s"))
        & (F.col("salt") == F.col("t")),
    ).drop("l", "s", "t", "lang", "source")


def _with(vectors: DataFrame, params: DataFrame) -> DataFrame:
    """Each vector with what its pool has, through (pool, salt): no pool is one task's."""
    other = _salted(params).withColumnsRenamed({"pool": "p", "salt": "t"})
    return vectors.join(other, (F.col("pool") == F.col("p")) & (F.col("salt") == F.col("t"))).drop("p", "t")


def minimum_covariance(vectors: DataFrame, steps: int = STEPS, core: float = CORE) -> DataFrame:
    """Location, factor and scale of each pool. Runs jobs, each a pass over the vectors.

    Starts from medians and the spread about them, then concentration steps: the share
    ``core`` of the nearest rows gives the next estimate, whose determinant is never larger.
    """
    centres = written(
        vectors.groupBy("pool").agg(*(F.percentile_approx(x, 0.5, 1000).alias(f"m_{x}") for x in _P)),
        "location",
    )
    start = _with(vectors, centres).groupBy("pool").agg(
        *(F.min(f"m_{x}").alias(f"m_{x}") for x in _P),
        *(F.percentile_approx(F.abs(F.col(x) - F.col(f"m_{x}")), 0.5, 1000).alias(f"a_{x}") for x in _P),
    )
    params = written(
        start.select(
            "pool",
            *(f"m_{x}" for x in _P),
            *(
                (F.greatest(1.4826 * F.col(f"a_{_P[i]}"), F.lit(VECTOR[_P[i]][1])) if i == j else F.lit(0.0)).alias(f"l{i}_{j}")
                for i, j in _PAIRS
            ),
        ),
        "estimate",
    )
    for _ in range(steps):
        params = written(_factor(_moments(_distance(_with(vectors, params)), core)), "estimate")
    counts = _distance(_with(vectors, params)).groupBy("pool", "bin").agg(F.count("*").alias("n"))
    middle = _limited(counts, 0.5, "middle").groupBy(F.col("pool").alias("p")).agg(F.min("middle").alias("middle"))
    # squared distances are put in proportion to the chi-square median
    scale = F.greatest(F.exp((F.col("middle") + 0.5) / _BIN) / CHI_MEDIAN, F.lit(1.0))
    return written(
        params.join(middle, F.col("pool") == F.col("p")).withColumn("scale", scale).drop("p", "middle"),
        "estimate",
    )


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Statistics and verdict of every document; ``kept`` is false if it fails a rule.

    One row per input row. Null language or source are groups of their own. Documents of pools
    smaller than ``MIN_POOL`` are judged by their whole language, or by the whole table where
    that is small too; an empty table gives no rows. ``outlier``
    is the squared distance in proportion, null for documents that fail the base rules.
    """
    stats = written(text_statistics(docs, "doc_id", "lang", "source"), "statistics")
    vectors = written(_pools(stats), "vectors")
    estimated = vectors.select(F.explode("pools").alias("pool"), "salt", *_P)
    judged = _distance(_with(vectors, minimum_covariance(estimated))).select(
        F.col("doc_id").alias("d"), F.col("text_key").alias("k"), (F.col("d2") / F.col("scale")).alias("outlier"), F.col("pool")
    )
    # equal rows share their statistics and pool, so one verdict serves them all
    once = judged.groupBy("d", "k").agg(F.min("outlier").alias("outlier"), F.min("pool").alias("pool"))
    return stats.join(
        once, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left"
    ).select(
        *stats.columns,
        "outlier",
        "pool",
        (~F.col("base_failed") & (F.coalesce("outlier", F.lit(0.0)) <= cutoff)).alias("kept"),
    )
