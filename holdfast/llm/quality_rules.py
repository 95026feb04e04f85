"""Quality rules with thresholds learned per language and source from mergeable quantile sketches.

Texts are measured in place. For each measure a quantile sketch (KLL) is built per language and source where the rows are
read, merged per group, and merged again per language and over all; a group with too few rows takes the next wider one's
fences. A fence stands a multiple of the quartile range beyond the quartile, so a group whose texts are alike rejects
none of them, whatever their usual level. Only built-in functions are used.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import SPACES
from holdfast.session import store

SYMBOLS = "#*$%&|<>"
#: Fixed part of the rules.
MIN_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: Rows that a group needs for fences of its own.
GROUP_ROWS = 100
#: Quartile ranges between quartile and fence.
REACH = 4.0
#: Groups whose fences may be broadcast; beyond that they are joined by shuffle, where adaptive execution splits hot ones.
BROADCAST_GROUPS = 20_000

#: Measures made of the base counts: SQL, smallest quartile range that counts, and whether low values are rejected as well.
MEASURES = {
    "symbols_per_char": ("n_symbols / word_chars", 0.004, False),
    "dup_line_share": ("n_dup_lines / n_lines", 0.05, False),
    "repeat_share": ("n_repeat_words / n_words", 0.05, False),
    "chars_per_word": ("word_chars / n_words", 0.5, True),
}

#: Columns that the rules add.
RESULTS = ("word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines", "n_repeat_words", *MEASURES, "base_failed", "kept")


def _words(text: Column) -> Column:
    """Runs of characters other than white space."""
    return F.filter(F.split(F.translate(text, SPACES[1:], " " * (len(SPACES) - 1)), " "), lambda w: w != "")


def measured(docs: DataFrame) -> DataFrame:
    """The rows with n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines and n_repeat_words."""
    text = F.coalesce("text", F.lit(""))
    spaceless = F.translate(text, SPACES, "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACES, "") != "")
    rows = docs.withColumns({
        "_words": _words(text), "word_chars": F.length(spaceless).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"), "_lines": lines,
    }).withColumns({
        "n_words": F.size("_words").cast("long"), "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_last": F.size("_words") - 2,
    })
    window = lambda i: F.concat_ws(" ", F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))
    places = F.when(F.col("_last") > 0, F.sequence(F.lit(0), F.col("_last") - 1)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("_windows", F.transform(places, window))
    # Only texts with a repeated window are looked at closer: equal windows stand side by side once sorted.
    ordered = F.array_sort(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    rows = rows.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"), ordered))
    twice = F.filter("_sorted", lambda x, i: (x["w"] == F.get("_sorted", i - 1)["w"]) | F.coalesce(
        x["w"] == F.get("_sorted", i + 1)["w"], F.lit(False)))
    at = F.transform(twice, lambda x: x["i"])
    rows = rows.withColumn("_at", at)
    covered = F.array_union(F.array_union("_at", F.transform("_at", lambda i: i + 1)), F.transform("_at", lambda i: i + 2))
    return rows.withColumn("n_repeat_words", F.coalesce(F.size(covered), F.lit(0)).cast("long")).drop(
        "_words", "_lines", "_last", "_windows", "_sorted", "_at")


def with_measures(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        name: F.expr(f"try_divide({sql.split(' / ')[0]}, {sql.split(' / ')[1]})") for name, (sql, _, _) in MEASURES.items()})


def sketches(rows: DataFrame) -> DataFrame:
    """One sketch per measure of the texts that the base rules pass, per language and source."""
    return rows.where("not base_failed").groupBy("lang", "source").agg(
        F.count("*").alias("rows"), *[F.kll_sketch_agg_double(F.col(name)).alias(name) for name in MEASURES])


def fences(groups: DataFrame, group_rows: int = GROUP_ROWS, reach: float = REACH) -> DataFrame:
    """Lowest and highest value that pass, for each language and source of the sketches."""
    def merged(keys: list[str], prefix: str) -> DataFrame:
        return groups.groupBy(*keys).agg(F.sum("rows").alias(f"{prefix}rows"), *[
            F.kll_merge_agg_double(name).alias(f"{prefix}{name}") for name in MEASURES])

    groups = groups.withColumn("one", F.lit(1))
    by_language = merged(["lang"], "lang_").withColumnRenamed("lang", "_lang")
    wide = groups.join(by_language, F.col("lang").eqNullSafe(F.col("_lang"))).join(merged(["one"], "all_"), "one")
    columns = []
    for name, (_, least, low) in MEASURES.items():
        sketch = F.when(F.col("rows") >= group_rows, F.col(name)).when(
            F.col("lang_rows") >= group_rows, F.col(f"lang_{name}")).otherwise(F.col(f"all_{name}"))
        first, third = (F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in (0.25, 0.75))
        spread = F.greatest(third - first, F.lit(least)) * reach
        columns += [(first - spread if low else F.lit(float("-inf"))).alias(f"{name}_low"),
                    (third + spread).alias(f"{name}_high")]
    return wide.select("lang", "source", *columns)


def quality_rules(
    docs: DataFrame, keep: list[str] | None = None, group_rows: int = GROUP_ROWS, reach: float = REACH,
) -> DataFrame:
    """The rows (columns `keep`, else all) with base counts, measures, base_failed and kept.

    base_failed: fewer than MIN_WORDS words, or more than half of them in three-word windows that come twice. Texts that
    pass it are kept if no measure is beyond the fences of their language and source (null is a language and a source
    like any other). Null and empty texts have no words and fail. Repeated rows count each; an empty table gives no rows.
    Measured rows are stored once, so texts are measured once; a caller that does not need the text back leaves it
    out of `keep`. Input columns called like a result give way to it.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    # Named by place, so that no kept column is called like one that is made.
    own = {c: f"_in{i}" for i, c in enumerate(keep)}
    source = docs.select(*[F.col(f"`{c}`").alias(name) for c, name in own.items()], "text", "lang", "source")
    rows = with_measures(measured(source)).withColumn(
        "base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words"))
    rows = store(rows.select(*own.values(), "lang", "source", *RESULTS[:-1]), "measured")
    groups = store(sketches(rows), "sketches")
    limits = fences(groups, group_rows, reach)
    if groups.count() <= BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = rows.join(
        limits, rows["lang"].eqNullSafe(limits["_lang"]) & rows["source"].eqNullSafe(limits["_source"]), "left")
    passed = F.lit(True)
    for name in MEASURES:
        passed &= F.coalesce(F.col(name).between(F.col(f"{name}_low"), F.col(f"{name}_high")), F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & passed).select(
        *[F.col(name).alias(c) for c, name in own.items()], *RESULTS)
