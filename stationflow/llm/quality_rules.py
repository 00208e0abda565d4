"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each text gives a vector of transformed statistics. For every (lang, source)
the minimum-covariance-determinant estimate is found by concentration steps
that Spark runs over all rows at once: from a median/MAD start, distances under
the present estimate, the bin of the h-quantile per group (counts of binned
distances, so no group is ever sorted or gathered), then moments of the rows
within it. h is half of the group, so the estimate holds until outliers are
nearly half; a last step takes the moments of all rows within a chi-square
quantile of it. What is known of a group (one row) goes to its rows, by broadcast
up to a measured size and by a salted join beyond, so rows are never shuffled by
their group: they meet only in partial sums, and a group that holds a third of
all rows costs no more per task than any other. Small groups share an
estimate with the other small groups of their language, and very small languages
one estimate together. Rows far out by Mahalanobis distance are rejected.

Defined cases: a null or empty text fails the base rule (under 50 words); null
lang or source are groups of their own; rows of one group with equal statistics
(copies) count once in its estimate and its size, and are judged one by one; an
empty table gives no rows; statistics that do not vary within a
group get a floor of variance instead of a singular estimate."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.shared import fresh, stored

LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: Share of a group that the concentration steps keep, their number, the size
#: from which a group has its own estimate.
KEEP, STEPS, LEAST_GROUP = 0.5, 5, 200
#: Chi-square quantile within which rows enter the reweighted estimate.
REWEIGHT = 0.975
#: Standard deviation that each statistic has at least.
FLOORS = {"f_chars": 0.05, "f_symbols": 0.25, "f_dups": 0.08, "f_repeats": 0.08, "f_upper": 0.08, "f_marks": 0.10}
#: Rejected beyond this squared distance: the chi-square quantile 1 - 1e-9 for
#: six statistics.
CUTOFF = 53.34
FEATURES = tuple(FLOORS)
#: Bytes of a table of groups up to which it is broadcast, and the number of
#: parts that the rows of a group are dealt into where it is not.
MOST_BROADCAST_BYTES, SALTS = 16 << 20, 64
#: A group's estimate: six means and 36 entries of its precision, with their heads.
_GROUP_BYTES = 512
_BINS_PER_OCTAVE = 64

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_MARKS = re.compile(r"[^\w\x20\x09-\x0D]")


def text_statistics(text: str | None) -> tuple[int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, upper-case
    letters, punctuation marks."""
    words = _WORD.findall(text or "")
    if not words:
        return 0, 0, len(_SYMBOLS.findall(text or "")), 0, 0, 0, 0
    n = len(words)
    repeated = 0
    if n > 3:
        ids: dict[str, int] = {}
        a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
        m = len(ids)
        if m < 2_000_000:
            key = (a[:-2] * m + a[1:-1]) * m + a[2:]
        else:  # three ids no longer fit one integer
            key = np.unique(np.stack([a[:-2], a[1:-1], a[2:]], axis=1), axis=0, return_inverse=True)[1].ravel()
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = count[back] > 1
        if twice.any():
            covered = np.zeros(n, dtype=bool)
            for k in range(3):
                covered[k : n - 2 + k] |= twice
            repeated = int(covered.sum())
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return (
        n,
        sum(map(len, words)),
        len(_SYMBOLS.findall(text)),
        len(lines) - len(set(lines)),
        repeated,
        sum(map(str.isupper, text)) if not text.islower() else 0,
        len(_MARKS.findall(text)),
    )


def with_statistics(documents: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the statistics of each whole text."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_statistics(t.as_py()) for t in batch.column(3)]
            cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 7
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *cols], names)

    names = ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks"]
    rows = documents.select("doc_id", "lang", "source", "text")
    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in names[:3]), *(f"{c} long" for c in names[3:])])
    return rows.mapInArrow(measured, schema)


def _transformed(stats: DataFrame) -> DataFrame:
    """Statistics of a share or mean, on scales where clean text is about normal."""
    per = lambda c: f"({c} / greatest(n_words, 1))"
    return stats.selectExpr(
        "*",
        f"ln(greatest({per('word_chars')}, 0.01)) as f_chars",
        f"ln(1 + 100 * {per('n_symbols')}) as f_symbols",
        f"sqrt({per('n_dup_lines')}) as f_dups",
        f"sqrt(least(1, {per('n_repeat_words')})) as f_repeats",
        "sqrt(n_upper / greatest(word_chars, 1)) as f_upper",
        f"sqrt({per('n_marks')}) as f_marks",
    )


def _is_small(groups: DataFrame, most: int) -> bool:
    """Whether a table of one row per group (stored before) may be broadcast."""
    names = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in groups.dtypes if kind == "string"]
    return (groups.agg(F.sum(sum(names, F.lit(_GROUP_BYTES)))).first()[0] or 0) <= most


def _with_group(rows: DataFrame, groups: DataFrame, small: bool, how: str = "inner", keys: dict[str, str] | None = None) -> DataFrame:
    """Rows with what ``groups`` knows of their group. ``keys``: null-safe pairs
    of a column of rows and one of groups (default: ``g``)."""
    pairs = keys or {"g": "_g"}
    if keys is None:
        groups = groups.withColumnRenamed("g", "_g")
    same = [f"{a} <=> {b}" for a, b in pairs.items()]
    if small:
        return rows.join(F.broadcast(groups), F.expr(" and ".join(same)), how).drop(*pairs.values())
    dealt = rows.withColumn("_salt", F.expr(f"pmod(xxhash64({', '.join(f'`{c}`' for c in rows.columns)}), {SALTS})"))
    each = groups.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = dealt.join(each.hint("merge"), F.expr(" and ".join(["_salt = _part", *same])), how)
    return joined.drop("_salt", "_part", *pairs.values())


def _grouped(stats: DataFrame, least: int, most_broadcast: int) -> DataFrame:
    """Adds ``g``, the group whose estimate a row is judged by."""
    own = F.concat(F.coalesce(F.concat(F.lit("l"), "lang"), F.lit("-")), F.lit("\x00"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")))
    of_lang = F.concat(F.coalesce(F.concat(F.lit("l"), "lang"), F.lit("-")), F.lit("\x00*"))
    counts = stats.where("not base_failed").select("lang", "source", *FEATURES).distinct().groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = counts.withColumn("g", F.when(F.col("n") >= least, own).otherwise(of_lang))
    pooled = small.groupBy("g").agg(F.sum("n").alias("m"))
    named = small.join(pooled, "g").withColumn("g", F.when(F.col("m") >= least, F.col("g")).otherwise(F.lit("*")))
    named = stored(named.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "g"), "quality-groups")
    return _with_group(stats, named, _is_small(named, most_broadcast), "left", {"lang": "_l", "source": "_s"})


def _squared(features: tuple[str, ...]) -> str:
    """Squared Mahalanobis distance under mean ``mu`` and precision ``pr``."""
    p = len(features)
    d = [f"({f} - mu[{i}])" for i, f in enumerate(features)]
    terms = [f"{'' if i == j else '2 * '}pr[{i * p + j}] * {d[i]} * {d[j]}" for i in range(p) for j in range(i, p)]
    return " + ".join(terms)


def _moments(features: tuple[str, ...]) -> list:
    p = len(features)
    firsts = [F.sum(f).alias(f"s{i}") for i, f in enumerate(features)]
    seconds = [F.sum(F.expr(f"{features[i]} * {features[j]}")).alias(f"q{i}_{j}") for i in range(p) for j in range(i, p)]
    return [F.count("*").alias("n"), *firsts, *seconds]


def _estimates(moments: DataFrame, floors: list[float], keep: float) -> DataFrame:
    """Mean and precision from a group's sums (one row per group)."""
    p = len(floors)
    # Consistency of a covariance taken from the inner share of a normal group:
    # E[chi2_p within its keep-quantile] / p, by simulation-free quadrature.
    scale = _inner_share(keep, p)

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, mu, pr = [], [], []
            for row in batch.to_pylist():
                n = row["n"]
                mean = np.array([row[f"s{i}"] for i in range(p)]) / n
                cov = np.zeros((p, p))
                for i in range(p):
                    for j in range(i, p):
                        cov[i, j] = cov[j, i] = row[f"q{i}_{j}"] / n - mean[i] * mean[j]
                cov = cov / scale + np.diag(np.square(floors))
                g.append(row["g"])
                mu.append(mean.tolist())
                pr.append(np.linalg.inv(cov).ravel().tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(g, pa.string()), pa.array(mu, pa.list_(pa.float64())), pa.array(pr, pa.list_(pa.float64()))], ["g", "mu", "pr"]
            )

    return moments.mapInArrow(solved, "g string, mu array<double>, pr array<double>")


def _inner_share(keep: float, p: int) -> float:
    """E[x | x within the keep-quantile] / p for chi-square x with p degrees."""
    if keep >= 1:
        return 1.0
    x, w = _chi_square(p)
    inner = np.cumsum(w) / w.sum() <= keep
    return float((x * w)[inner].sum() / w[inner].sum() / p)


def _quantile(share: float, p: int) -> float:
    """Quantile of chi-square with p degrees."""
    x, w = _chi_square(p)
    return float(x[np.searchsorted(np.cumsum(w) / w.sum(), share)])


def _chi_square(p: int) -> tuple[np.ndarray, np.ndarray]:
    """A grid and the density on it, up to a factor."""
    x = np.linspace(1e-9, 80, 400_001)
    return x, x ** (p / 2 - 1) * np.exp(-x / 2)


def robust_estimates(
    rows: DataFrame, *, features: tuple[str, ...] = FEATURES, floors: list[float] | None = None, keep: float = KEEP, steps: int = STEPS,
    most_broadcast: int = MOST_BROADCAST_BYTES,
) -> DataFrame:
    """``g, mu, pr``: the estimate of each group of ``rows`` (columns ``g`` and
    the features; equal rows count once), stored after each step so that lineage
    stays short."""
    floors = floors or [FLOORS[f] for f in features]
    rows = stored(rows.select("g", *features).distinct(), "mcd-rows")
    middle = [F.percentile_approx(f, 0.5, 1000).alias(f"m{i}") for i, f in enumerate(features)]
    start = stored(rows.groupBy("g").agg(*middle), "mcd-start")
    # One row per group here and in every later step.
    small = _is_small(start, most_broadcast)
    spread = [
        F.percentile_approx(F.abs(F.col(f) - F.col(f"m{i}")), 0.5, 1000).alias(f"a{i}") for i, f in enumerate(features)
    ]
    scale = _with_group(rows, start, small).groupBy("g").agg(*spread).join(start, "g")
    p = len(features)
    var = [f"(pow(1.4826 * a{i}, 2) + pow({fl}, 2))" for i, fl in enumerate(floors)]
    pr = ", ".join(f"1 / {var[i]}" if i == j else "0d" for i in range(p) for j in range(p))
    now = stored(scale.selectExpr("g", f"array({', '.join(f'm{i}' for i in range(p))}) as mu", f"array({pr}) as pr"), "mcd-0")
    bins = f"cast(floor({_BINS_PER_OCTAVE} * log2(1e-6 + {_squared(features)})) as int)"
    for step in range(steps):
        counts = _with_group(rows, now, small).withColumn("_bin", F.expr(bins)).groupBy("g", "_bin").agg(F.count("*").alias("c"))
        # A group has at most a few thousand bins, whatever its number of rows.
        upto = counts.selectExpr("g", "_bin", "sum(c) over (partition by g order by _bin) as u", "sum(c) over (partition by g) as t")
        edge = upto.where(f"u >= {keep} * t").groupBy("g").agg(F.min("_bin").alias("_edge"))
        bounded = stored(now.join(edge, "g"), f"mcd-edge-{step}")
        inner = _with_group(rows, bounded, small).where(f"{bins} <= _edge").groupBy("g").agg(*_moments(features))
        now = stored(_estimates(inner, floors, keep), f"mcd-{step + 1}")
    near = _with_group(rows, now, small).where(f"{_squared(features)} <= {_quantile(REWEIGHT, p)}")
    return stored(_estimates(near.groupBy("g").agg(*_moments(features)), floors, REWEIGHT), "mcd-reweighted")


def _judged(documents: DataFrame, cutoff: float, least_group: int, most_broadcast: int = MOST_BROADCAST_BYTES) -> DataFrame:
    base = f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words"
    stats = stored(_transformed(with_statistics(documents)).withColumn("base_failed", F.expr(base)), "quality-statistics")
    rows = _grouped(stats, least_group, most_broadcast)
    estimates = robust_estimates(rows.where("not base_failed").select("g", *FEATURES), most_broadcast=most_broadcast)
    judged = _with_group(rows, estimates, _is_small(estimates, most_broadcast), "left")
    judged = judged.withColumn("distance", F.when(~F.col("base_failed"), F.expr(_squared(FEATURES))))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff))


def judge_quality(
    documents: DataFrame, *, cutoff: float = CUTOFF, least_group: int = LEAST_GROUP, most_broadcast: int = MOST_BROADCAST_BYTES
) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance`` per row (distance squared; null if the base
    rule failed)."""
    return _judged(documents, cutoff, least_group, most_broadcast).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def drop_low_quality(documents: DataFrame, *, cutoff: float = CUTOFF, least_group: int = LEAST_GROUP) -> DataFrame:
    """Documents that the rules keep, unchanged. Rows are told apart by id,
    language, source and text, so repeated ids are judged row by row."""
    mark = fresh(documents, "_mark")
    marked = documents.withColumn(mark, F.xxhash64("text"))
    row = F.struct("doc_id", mark).alias("doc_id")
    judged = _judged(marked.select(row, "lang", "source", "text"), cutoff, least_group)
    gone = judged.where("not kept").select(F.col(f"doc_id.{mark}").alias("_m"), F.col("doc_id.doc_id").alias("_d"), F.col("lang").alias("_l"), F.col("source").alias("_s")).distinct()
    same = marked["doc_id"].eqNullSafe(gone["_d"]) & (marked[mark] == gone["_m"])
    same = same & marked["lang"].eqNullSafe(gone["_l"]) & marked["source"].eqNullSafe(gone["_s"])
    return marked.join(gone, same, "left_anti").drop(mark)
