"""Quality rules as robust multivariate outliers, with DataFrame functions only.

Text statistics are computed in one pass over the texts and written once. For each language and source the minimum
covariance determinant estimate is sought by concentration steps: mean and covariance of the three quarters of rows that
lie nearest, again and again, which never raises the determinant. There are STARTS starts: medians and absolute
deviations, and STARTS - 1 elemental sets of six rows, drawn by hashes. All take FIRST steps; of each group the start
with the least determinant goes on until its determinant falls no more. A row is kept if its squared Mahalanobis
distance stays under the cut. Covariances are inverted by a Cholesky factor written out as columns. Quantiles are counts
of narrow bins, so they don't depend on how partial results are merged. Only the tables of estimates and radii are joined
back, broadcast while they are small, so the rows of a hot group stay where they are.

Rows fail the base rules with fewer than 50 words or more than half of their words in repeated three-word windows; they
neither shape the estimates nor are kept. A group of fewer than `min_group` sound rows is judged by the estimate of all
rows of its language, and a language of fewer by that of all rows. Null texts have no words; null languages and sources
are groups of their own; repeated rows each count and each get a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

_BLANKS = " \t\n\x0b\x0c\r"
_WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Transformed statistics, and the least variance that an estimate may give them: what is rarely nonzero has none else.
#: Each alone can pass the cut: at 38 % duplicate lines, at 29 % repeated words, at one symbol for five words where others have none.
FEATURES = {"f_words": 0.25, "f_length": 0.01, "f_symbols": 0.25, "f_lines": 0.1, "f_repeats": 0.1}
#: Share of rows in a concentration step; squared distance beyond which a row is an outlier (chi-squared of 5, 1e-6).
CORE, CUT = 0.75, 35.9
#: Starts, steps that all of them take, and rows of an elemental set.
STARTS, FIRST, ELEMENTAL = 5, 2, 6
#: Most groups whose estimates are broadcast.
GROUPS = 100_000
#: Makes the covariance of the nearest three quarters that of all rows, for normal data of five dimensions.
CONSISTENCY = 1.6
#: Bins for a unit of a statistic, and for a unit of the logarithm of a squared distance.
FINE, BINS = 500, 200
#: A group whose determinant's logarithm falls by no more in a step stands still and takes no further one.
STILL = 0.01
KEY = ["k_lang", "k_source"]
_ANY = "\x00\x00"


def text_stats(docs: DataFrame) -> DataFrame:
    """The table's columns and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(_BLANKS))
    out = docs.withColumns(
        {
            "_w": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _WORD_GAP)),
            "_l": F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != ""),
            "word_chars": F.length(F.translate(text, _BLANKS, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        }
    )
    windows = F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))
    out = out.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "n_lines": F.size("_l").cast("long"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
            "_t": F.when(F.size("_w") >= 3, windows).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop("_w", "_l")
    pairs = F.transform("_t", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    out = out.withColumn("_s", F.when(F.size(F.array_distinct("_t")) < F.size("_t"), F.sort_array(pairs)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))).drop("_t")
    twice = F.filter("_s", lambda x, i: (x["h"] == F.get("_s", i - 1)["h"]) | (x["h"] == F.get("_s", i + 1)["h"]))
    out = out.withColumn("_p", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("_s")
    covered = F.aggregate(
        F.transform("_p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_p", i + 1) - p, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x
    )
    return out.withColumn("n_repeat_words", F.when(F.size("_p") > 0, covered).otherwise(F.lit(0).cast("long"))).drop("_p")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _features() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "f_words": F.log(words),
        "f_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        "f_symbols": F.log1p(100 * F.col("n_symbols") / words),
        "f_lines": F.log1p(20 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "f_repeats": F.log1p(20 * F.col("n_repeat_words") / words),
    }


def _estimate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Center m_* and Cholesky factor c_*_* of the (floored) covariance of the rows, for each key; and logdet."""
    names = list(FEATURES)
    aggs = [F.avg(f).alias(f"m_{f}") for f in names]
    aggs += [F.coalesce(F.covar_pop(a, b), F.lit(0.0)).alias(f"v_{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if j <= i]
    return _cholesky(rows.groupBy(*keys).agg(*aggs), CONSISTENCY)


def _cholesky(est: DataFrame, scale: float) -> DataFrame:
    names = list(FEATURES)
    for i in range(len(names)):
        for j in range(i + 1):
            v = scale * F.col(f"v_{i}_{j}") + (F.lit(FEATURES[names[i]]) if i == j else F.lit(0.0))
            for k in range(j):
                v = v - F.col(f"c_{i}_{k}") * F.col(f"c_{j}_{k}")
            est = est.withColumn(f"c_{i}_{j}", F.sqrt(F.greatest(v, F.lit(1e-9))) if i == j else v / F.col(f"c_{j}_{j}"))
    logdet = sum((2 * F.log(f"c_{i}_{i}") for i in range(len(names))), F.lit(0.0))
    return est.drop(*(f"v_{i}_{j}" for i in range(len(names)) for j in range(i + 1))).withColumn("logdet", logdet)


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    y: list[Column] = []
    for i, f in enumerate(FEATURES):
        v = F.col(f) - F.col(f"m_{f}")
        for k in range(i):
            v = v - F.col(f"c_{i}_{k}") * y[k]
        y.append(v / F.col(f"c_{i}_{i}"))
    total = y[0] * y[0]
    for v in y[1:]:
        total = total + v * v
    return total


def _small(groups: DataFrame) -> DataFrame:
    """A table of a few rows a group, broadcast up to GROUPS rows (about 30 MB); beyond, Spark shuffles the join."""
    return F.broadcast(groups) if groups.count() <= GROUPS else groups


def _quantile(rows: DataFrame, keys: list[str], bin_: Column, share: float) -> DataFrame:
    """keys and _q: the first bin at which a share of the key's rows is reached."""
    counts = rows.groupBy(*keys, bin_.alias("_bin")).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bin"))
    whole = F.sum("_n").over(Window.partitionBy(*keys))
    return counts.select(*keys, "_bin", upto.alias("_upto"), whole.alias("_all")).where(F.col("_upto") >= share * F.col("_all")).groupBy(*keys).agg(F.min("_bin").alias("_q"))


def _starts(fit: DataFrame, store: common.Durable) -> DataFrame:
    """An estimate for each key and start."""
    names = list(FEATURES)
    each = fit.select(*KEY, F.posexplode(F.array(*names)).alias("_f", "_x"))
    middle = _quantile(each, [*KEY, "_f"], F.floor(F.col("_x") * FINE), 0.5).withColumn("_m", (F.col("_q") + 0.5) / FINE).drop("_q")
    middle = store.put(middle)
    apart = F.floor(F.abs(F.col("_x") - F.col("_m")) * FINE)
    spread = _quantile(each.join(_small(middle), [*KEY, "_f"]), [*KEY, "_f"], apart, 0.5).withColumn("_d", (F.col("_q") + 0.5) / FINE).drop("_q")
    both = middle.join(spread, [*KEY, "_f"])
    of = lambda c, i: F.max(F.when(F.col("_f") == i, F.col(c)))
    plain = both.groupBy(*KEY).agg(*(of("_m", i).alias(f"m_{f}") for i, f in enumerate(names)), *(of("_d", i).alias(f"d_{f}") for i, f in enumerate(names)))
    for i, f in enumerate(names):
        for j in range(i + 1):
            plain = plain.withColumn(f"v_{i}_{j}", (1.4826 * F.col(f"d_{f}")) ** 2 if i == j else F.lit(0.0))
    plain = _cholesky(plain.drop(*(f"d_{f}" for f in names)), 1.0).withColumn("start", F.lit(0))
    row = F.struct(*names)
    drawn = fit.groupBy(*KEY).agg(*(F.min_by(row, F.xxhash64("doc_id", *names, F.lit(s * ELEMENTAL + k))).alias(f"_{s}_{k}") for s in range(1, STARTS) for k in range(ELEMENTAL)))
    drawn = drawn.select(*KEY, F.explode(F.array(*(F.struct(F.lit(s).alias("start"), F.array(*(F.col(f"_{s}_{k}") for k in range(ELEMENTAL))).alias("rows")) for s in range(1, STARTS)))).alias("_s"))
    drawn = drawn.select(*KEY, "_s.start", F.explode("_s.rows").alias("_r")).select(*KEY, "start", "_r.*")
    return store.put(plain.unionByName(_estimate(drawn, [*KEY, "start"])))


def _step(fit: DataFrame, estimate: DataFrame, store: common.Durable) -> DataFrame:
    """A concentration step of each key and start: the estimate of the CORE of rows nearest by the one before."""
    keys = [*KEY, "start"]
    at = fit.join(_small(estimate.drop("logdet")), KEY).withColumn("_b", F.floor(F.log1p(_distance()) * BINS)).select(*keys, *FEATURES, "_b")
    radius = store.put(_quantile(at, keys, F.col("_b"), CORE))
    return store.put(_estimate(at.join(_small(radius), keys).where("_b <= _q"), keys))


def estimates(fit: DataFrame, store: common.Durable, max_steps: int) -> DataFrame:
    """The minimum covariance determinant estimate of each key's rows (KEY, doc_id, FEATURES): m_*, c_*_*, logdet."""
    estimate = _starts(fit, store)
    for _ in range(FIRST):
        estimate = _step(fit, estimate, store)
    best = estimate.groupBy(*KEY).agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    estimate = store.put(estimate.join(best, [*KEY, "start"]))
    lower = estimate
    for _ in range(max_steps):
        new = _step(fit, lower, store).join(estimate.select(*KEY, F.col("logdet").alias("_old")), KEY)
        lower = store.put(new.where(F.col("logdet") < F.col("_old") - STILL).drop("_old"))
        if lower.isEmpty():
            break
        estimate = store.put(estimate.join(lower.select(*KEY), KEY, "left_anti").unionByName(lower))
    return estimate


def _keyed(stats: DataFrame, min_group: int, store: common.Durable) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with the key of the estimate that judges them, the sound rows of each key (a row may shape several), and the table of keys."""
    sound = stats.where("not base_failed")
    groups = store.put(sound.groupBy("g_lang", "g_source").agg(F.count("*").alias("n")))
    langs = groups.groupBy("g_lang").agg(F.sum("n").alias("n_lang"))
    own, lang = F.col("n") >= min_group, F.col("n_lang") >= min_group
    keys = groups.join(langs, "g_lang").select("g_lang", "g_source", F.when(own | lang, F.col("g_lang")).otherwise(F.lit(_ANY)).alias("k_lang"), F.when(own, F.col("g_source")).otherwise(F.lit(_ANY)).alias("k_source"))
    keys = store.put(keys)
    rows = stats.join(_small(keys), ["g_lang", "g_source"], "left")
    columns = [*KEY, "doc_id", *FEATURES]
    shared = store.put(keys.where(F.col("k_source") == _ANY).select(*KEY).distinct())
    fit = rows.where(~F.col("base_failed") & (F.col("k_source") != _ANY)).select(*columns)
    if not shared.isEmpty():
        by_lang = sound.join(_small(shared.where(F.col("k_lang") != _ANY)), F.col("g_lang") == F.col("k_lang")).select(*columns)
        fit = fit.unionByName(by_lang)
        if not shared.where(F.col("k_lang") == _ANY).isEmpty():
            fit = fit.unionByName(sound.withColumns({k: F.lit(_ANY) for k in KEY}).select(*columns))
    return rows, fit, keys


def judge(docs: DataFrame, max_steps: int = 20, min_group: int = 40, cut: float = CUT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance.

    docs: doc_id, text, lang, source; other columns are left out. max_steps: steps of the best starts at most, should
    they not stand still before; the last estimate then counts.
    """
    store = common.Durable(docs.sparkSession, "mcd")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")).alias(f"g_{c}") for c in ("lang", "source")))
    stats = store.put(text_stats(plain).drop("text").withColumns(_features()).withColumn("base_failed", base_failed()))
    rows, fit, keys = _keyed(stats, min_group, store)
    estimate = estimates(store.put(fit), store, max_steps)
    store.keep(stats, keys, estimate)
    judged = rows.join(_small(estimate), KEY, "left").withColumn("distance", _distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(True))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), F.when(~F.col("base_failed"), F.col("distance")).alias("distance"))
