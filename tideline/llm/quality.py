"""Quality rules and robust multivariate outliers, in DataFrame expressions only.

Base rules come first. Of the rows that pass them, transformed statistics are compared within their language
and source: a minimum-covariance-determinant estimate (concentration steps from a median start, then a
reweighted step) gives centre and scatter, and a row far away by Mahalanobis distance is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.frames import kept_table, whole_text

# The base rules' words, symbols and limits.
SPACES = r"[ \t-\r]+"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

STATS = ["x_word_length", "x_symbols", "x_dup_lines", "x_repeats", "x_upper"]
#: No scatter is taken to be narrower than this, so a statistic that hardly varies rejects only clear deviations.
LEAST_SPREAD = {"x_word_length": 0.08, "x_symbols": 0.08, "x_dup_lines": 0.05, "x_repeats": 0.08, "x_upper": 0.06}
#: Squared distance that a row of a five-dimensional normal distribution exceeds once in about 10 million.
CUTOFF = 41.0
#: A language and source with fewer rows is estimated with its whole language.
LEAST_ROWS = 200


def _held(frame: DataFrame, **columns: Column) -> DataFrame:
    """The frame with more columns, through a generator: the optimizer does not work them out again wherever they are used."""
    return frame.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def base_statistics(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, lang, source, counts of the base rules and the number of upper-case letters.

    With ``carry`` each row comes along whole, as ``row``.
    """
    row = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []
    text, none = F.col("text"), F.array().cast("array<string>")
    bare = F.expr("trim(BOTH ' \t\n\x0B\f\r' FROM text)")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", whole_text().alias("text"), *row)
    cut = _held(rows, words=F.when(bare == "", none).otherwise(F.split(bare, SPACES)), lines=lines)
    w = F.col("words")
    n = F.size(w)
    stripped = text
    for s in SYMBOLS:
        stripped = F.replace(stripped, F.lit(s), F.lit(""))
    counted = cut.select(
        "doc_id", "lang", "source",
        n.cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(stripped)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).alias("n_upper"),
        *(["row"] if carry else []),
        F.inline(F.array(F.struct(F.transform(w, lambda x: F.xxhash64(x)).alias("h")))),
    )
    h = F.col("h")
    starts = F.slice(h, F.lit(1), F.greatest(F.size(h) - 2, F.lit(0)))
    counted = _held(counted, windows=F.transform(starts, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))).drop("h")
    windows = F.col("windows")
    repeats = F.size(windows) > F.size(F.array_distinct(windows))
    counted = _held(counted, ordered=F.when(repeats, F.sort_array(windows)))
    ordered = F.col("ordered")
    # Windows found twice or more: in order, those equal to the one before.
    twice = F.array_distinct(F.filter(ordered, lambda x, i: x == F.get(ordered, i - 1)))
    counted = _held(counted, twice=F.when(ordered.isNotNull(), twice)).drop("ordered")
    return counted.withColumn("n_repeat_words", _repeated_words(windows, F.col("twice"))).drop("windows", "twice")


def _repeated_words(windows: Column, twice: Column) -> Column:
    """Words that lie in a window of ``twice``. Looked up one by one while there are few of these, by sorting beyond."""
    n = F.size(windows)
    few = F.filter(F.transform(windows, lambda x, i: F.when(F.array_contains(twice, x), i)), lambda i: i.isNotNull())
    placed = F.sort_array(F.arrays_zip(windows.alias("h"), F.sequence(F.lit(0), n - 1).alias("i")))
    before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), placed)
    three = F.arrays_zip(placed.alias("p"), before.alias("q"), F.slice(placed, F.lit(2), n).alias("r"))
    many = F.filter(
        three,
        lambda t: t["p"].isNotNull()
        & (F.coalesce(t["p"]["h"] == t["q"]["h"], F.lit(False)) | F.coalesce(t["p"]["h"] == t["r"]["h"], F.lit(False))),
    )
    at = F.when(F.size(twice) <= 64, few).otherwise(F.transform(many, lambda t: t["p"]["i"]))
    words = F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2))))
    return F.when(F.size(twice) > 0, F.size(words)).otherwise(0).cast("long")


def _transformed(rows: DataFrame) -> DataFrame:
    """Shares and lengths on scales where most texts lie in a round cloud, whatever their length."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")

    def angle(part: Column) -> Column:
        return F.asin(F.sqrt(F.least(part, F.lit(1.0))))

    return rows.withColumns(
        {
            "x_word_length": F.log(chars / words),
            "x_symbols": angle(F.col("n_symbols") / chars),
            "x_dup_lines": angle(F.col("n_dup_lines") / words),
            "x_repeats": angle(F.col("n_repeat_words") / words),
            "x_upper": angle(F.col("n_upper") / chars),
        }
    )


def _moments() -> list[Column]:
    p = range(len(STATS))
    return [F.avg(STATS[i]).alias(f"m{i}") for i in p] + [
        F.avg(F.col(STATS[i]) * F.col(STATS[j])).alias(f"s{i}{j}") for i in p for j in range(i + 1)
    ]


def _factors(moments: DataFrame, scale: float) -> DataFrame:
    """Cholesky factor of each group's (floored) covariance, in columns l00 .. l44, with the centre m0 .. m4."""
    cov = moments
    for i in range(len(STATS)):
        for j in range(i + 1):
            value = (F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * scale
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + LEAST_SPREAD[STATS[i]] ** 2
            cov = cov.withColumn(f"c{i}{j}", value)
    for j in range(len(STATS)):
        for i in range(j, len(STATS)):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            cov = cov.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}{j}"))
    return cov.select("grp", *[f"m{i}" for i in range(len(STATS))], *[f"l{i}{j}" for i in range(len(STATS)) for j in range(i + 1)])


def _distances(rows: DataFrame, factors: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d2`` of each row to its group, by forward substitution."""
    out = rows.join(factors, "grp", "left")
    total = F.lit(0.0)
    for i in range(len(STATS)):
        rest = F.col(STATS[i]) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"z{k}")
        out = out.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
        total = total + F.col(f"z{i}") * F.col(f"z{i}")
    return out.withColumn("d2", total).select(*rows.columns, "d2")


def _start(rows: DataFrame) -> DataFrame:
    """Distances to each group's medians, every statistic scaled by its own spread."""
    p = range(len(STATS))
    middle = rows.groupBy("grp").agg(
        *[F.percentile_approx(s, 0.5, 1000).alias(f"m{i}") for i, s in enumerate(STATS)],
        *[(F.percentile_approx(s, 0.75, 1000) - F.percentile_approx(s, 0.25, 1000)).alias(f"q{i}") for i, s in enumerate(STATS)],
    )
    spread = [F.sqrt(F.pow(F.col(f"q{i}") / 1.349, 2) + LEAST_SPREAD[STATS[i]] ** 2).alias(f"l{i}{i}") for i in p]
    zeros = [F.lit(0.0).alias(f"l{i}{j}") for i in p for j in range(i)]
    return _distances(rows, kept_table(middle.select("grp", *[f"m{i}" for i in p], *spread, *zeros), "centres"))


def mcd_factors(rows: DataFrame, kept_share: float = 0.75, steps: int = 3) -> DataFrame:
    """Centre and Cholesky factor of each group of ``rows`` (grp and the statistics): the reweighted estimate."""
    measured = _start(rows)
    # Consistency at the normal distribution of a covariance taken over the nearer three quarters.
    scale = 1.5
    for step in range(steps + 1):
        if step < steps:
            limit = kept_table(measured.groupBy("grp").agg(F.percentile_approx("d2", kept_share, 1000).alias("limit")), "limits")
            core = measured.join(limit, "grp").where("d2 <= limit")
        else:
            core, scale = measured.where(F.col("d2") <= 15.0), 1.0  # the reweighted step
        factors = kept_table(_factors(core.groupBy("grp").agg(*_moments()), scale), "centres")
        measured = _distances(rows, factors)
    return factors


COUNTS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _judged_by_rules(docs: DataFrame, carry: bool = False) -> DataFrame:
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return _transformed(base_statistics(docs, carry)).withColumn("base_failed", failed)


def _grouped(rows: DataFrame, names: DataFrame) -> DataFrame:
    same = rows["lang"].eqNullSafe(names["lang"]) & rows["source"].eqNullSafe(names["source"])
    return rows.join(names, same, "left").select(rows["*"], "grp")


def _fitted(stats: DataFrame, least_rows: int) -> tuple[DataFrame, DataFrame]:
    """Group of each language and source, and each group's estimate, from the rows that pass the rules."""
    passed = stats.where(~F.col("base_failed"))
    sizes = passed.groupBy("lang", "source").agg(F.count("*").alias("n"))
    language = F.concat(F.lit("l"), F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")))
    both = F.concat(language, F.lit("|s"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    names = kept_table(sizes.select("lang", "source", F.when(F.col("n") < least_rows, language).otherwise(both).alias("grp")), "groups")
    return names, mcd_factors(_grouped(passed.select("lang", "source", *STATS), names).select("grp", *STATS))


def _near_enough(cutoff: float) -> Column:
    return ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)


def quality_verdicts(docs: DataFrame, cutoff: float = CUTOFF, least_rows: int = LEAST_ROWS) -> DataFrame:
    """doc_id, counts, base_failed, kept and the distance ``d2`` of each row of ``docs``.

    ``docs``: doc_id, text, lang, source and any other columns. A null text is empty; a null language or source
    is a group of its own. Repeated rows and ids give a row each, an empty table none.
    """
    stats = kept_table(_judged_by_rules(docs), "statistics")
    names, factors = _fitted(stats, least_rows)
    measured = _distances(_grouped(stats.select(*COUNTS, *STATS, "lang", "source"), names), factors)
    return measured.select(*COUNTS, _near_enough(cutoff).alias("kept"), "d2")


def with_quality(docs: DataFrame, cutoff: float = CUTOFF, least_rows: int = LEAST_ROWS) -> DataFrame:
    """``docs`` without the rows that the rules or the outlier test reject.

    The statistics are worked out again beside the whole rows, which then meet only the small table of
    groups: no text goes through a shuffle. A null, empty or wordless text fails the rules and goes; null languages
    and sources are groups of their own; repeated rows are judged alike and stay or go together; columns of any name
    pass through; an empty table stays empty.
    """
    names, factors = _fitted(kept_table(_judged_by_rules(docs), "statistics"), least_rows)
    rows = _judged_by_rules(docs, carry=True).select("row", "lang", "source", "base_failed", *STATS)
    return _distances(_grouped(rows, names), factors).where(_near_enough(cutoff)).select("row.*")
