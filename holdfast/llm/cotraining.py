"""Quality classifier by co-training: a view of the text and a view of the page's metadata teach each other.

Both views are logistic regressions. They start from labelled documents; in each round each view labels the documents of
the unlabelled pool of which it is surest and hands them to the other view. Both are then calibrated on labelled documents
that were kept back, and their evidence is added.

The pool is every unlabelled document. Texts are measured once and their features stored; each round scores all of them
in Spark, a mergeable sketch finds the margins beyond which a view is surest, and every document beyond is handed over.
Which ones a view has handed over already follows from the earlier rounds' models and margins, so no state is kept beside
them. Only what a fit reads is bounded: a round's documents are drawn evenly from their languages and sources.
"""

import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import TEXT, slices
from holdfast.session import small_table, store

#: Most labelled documents to fit and calibrate on: those with the smallest hashes.
MOST_LABELLED = 20_000
#: Most of the documents that a view hands over in a round that the other view is fitted on.
MOST_TAUGHT = 4_000
ROUNDS = 4
#: Share of the pool that a view labels in a round, and the probability it needs for that.
TAUGHT_SHARE, CONFIDENCE = 0.05, 0.9
#: Rows whose features are made into matrices at once.
JUDGED_ROWS = 1_000
#: Ranks of margins are found to one in this many of the pool.
RANK_ACCURACY = 10_000
#: Share of the good documents that has to stay.
KEPT_GOOD = 0.99

_MARKS = b"#*$%&|<>!?.,;:'\"()[]{}/\\@=+-_~^`"
_LANGUAGES, _SOURCES = 16, 64


def content_features(text: bytes) -> np.ndarray:
    """Shares of character kinds and marks, and how words and lines repeat."""
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    size, words, lines = max(len(text), 1), text.split(), text.split(b"\n")
    n_words, n_lines = max(len(words), 1), max(len(lines), 1)
    shares = np.array([
        counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum(), counts[128:].sum(), counts[10], counts[32],
        *counts[np.frombuffer(_MARKS, dtype=np.uint8)]]) / size
    return np.concatenate([np.sqrt(shares), [
        len(set(words)) / n_words, len(set(map(bytes.lower, words))) / n_words, len(set(lines)) / n_lines,
        np.log1p(len(words)), size / n_words / 10, np.log1p(size / n_lines)]])


#: Columns of the content view.
CONTENT = 6 + len(_MARKS) + 6


def places(langs: list[str | None], sources: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the languages and sources; null is a value of its own."""
    return (np.array([zlib.crc32(repr(v).encode()) % _LANGUAGES for v in langs], dtype=np.int32),
            np.array([zlib.crc32(repr(v).encode()) % _SOURCES for v in sources], dtype=np.int32))


def metadata_features(langs: np.ndarray, sources: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Language, source and recorded length (nan: null) of each document."""
    out, rows, length = np.zeros((len(langs), _LANGUAGES + _SOURCES + 3)), np.arange(len(langs)), np.nan_to_num(chars)
    out[rows, langs] = 1
    out[rows, _LANGUAGES + sources] = 1
    out[:, -3] = np.log1p(np.maximum(length, 0))
    out[:, -2], out[:, -1] = out[:, -3] ** 2 / 10, np.isnan(chars)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Logistic:
    """Ridge logistic regression on scaled columns, fitted by Newton steps."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        # Summed row by row, so that a row's margin does not depend on the batch it comes in.
        return ((x - self.centre) / self.scale * self.weights[1:]).sum(1) + self.weights[0]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> Logistic:
    centre, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = np.hstack([np.ones((len(x), 1)), (x - centre) / scale])
    weights, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = sigmoid(z @ weights)
        gradient = z.T @ (y - p) - penalty * weights
        hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        weights = weights + step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(centre, scale, weights)


@dataclass
class Pair:
    """Both views with their calibration, the log-odds of the base rate, and the probability a document needs."""

    content: Logistic
    metadata: Logistic
    calibration: tuple[Logistic, Logistic]
    prior: float
    threshold: float

    def probabilities(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        one = self.calibration[0].margin(self.content.margin(content)[:, None])
        two = self.calibration[1].margin(self.metadata.margin(metadata)[:, None])
        return sigmoid(one), sigmoid(two), sigmoid(one + two - self.prior)


@dataclass
class Round:
    """Both views' models, and for each the margins up to which and from which it hands a document over as bad and good."""

    models: tuple[Logistic, Logistic]
    bounds: list[tuple[float, float]]


def handed_over(history: list[Round], view: int, x: np.ndarray) -> np.ndarray:
    """For each row the round in which the view hands it over, times two, and one more as good; -1 if it does not."""
    out = np.full(len(x), -1)
    for number, last in enumerate(history):
        margin, (low, high) = last.models[view].margin(x), last.bounds[view]
        out = np.where((out < 0) & (margin <= low), 2 * number, np.where((out < 0) & (margin >= high), 2 * number + 1, out))
    return out


def ranks(pool: int, left: int, rate: float, share: float = TAUGHT_SHARE) -> tuple[int, int]:
    """How many documents a view may hand over as bad and as good, of `left` that it has not handed over yet."""
    most = int(pool * share)
    return min(int(most * (1 - rate)), left), min(int(most * rate), left)


def bounds_of(margins: tuple[float, float] | None, counts: tuple[int, int]) -> tuple[float, float]:
    """The margins at the two ranks, as far as they are sure enough; none are handed over where a count is 0."""
    sure = float(np.log(CONFIDENCE / (1 - CONFIDENCE)))
    low = min(margins[0], -sure) if margins and counts[0] else -np.inf
    high = max(margins[1], sure) if margins and counts[1] else np.inf
    return low, high


def level(sizes: list[int], most: int) -> float:
    """The number of rows to draw from each group at most, so that all groups together give `most`."""
    left = float(most)
    for at, size in enumerate(sorted(sizes)):
        share = left / (len(sizes) - at)
        if size > share:
            return share
        left -= size
    return float(max(sizes, default=0))


_STORED = ["quality", "content", "lang", "src", "chars"]


def _matrices(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Both views' columns of a batch of stored features."""
    content = np.asarray(batch["content"].flatten(), dtype=float).reshape(-1, CONTENT)
    chars = np.asarray(batch["chars"].cast(pa.float64()).fill_null(np.nan))
    return content, metadata_features(np.asarray(batch["lang"]), np.asarray(batch["src"]), chars)


def _judged(pool: DataFrame, history: list[Round], models: tuple[Logistic, Logistic] | None) -> DataFrame:
    """doc_id, lang, src, and per view what handed_over says of the rounds so far and the margin by the new models."""
    kind = pool.schema["doc_id"].dataType.simpleString()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, JUDGED_ROWS) for b in batches for i in range(0, b.num_rows, JUDGED_ROWS)):
            views = _matrices(batch)
            given = [pa.array(handed_over(history, v, x), pa.int32()) for v, x in enumerate(views)]
            margins = [pa.array(models[v].margin(x) if models else np.zeros(len(x))) for v, x in enumerate(views)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["lang"], batch["src"], *given, *margins],
                names=["doc_id", "lang", "src", "given0", "given1", "margin0", "margin1"])

    return pool.select("doc_id", "content", "lang", "src", "chars").mapInArrow(
        mapped, f"doc_id {kind}, lang int, src int, given0 int, given1 int, margin0 double, margin1 double")


def _margins(pool: DataFrame, history: list[Round], models: tuple[Logistic, Logistic], counts: list[tuple[int, int]],
             left: list[int]) -> list[tuple[float, float] | None]:
    """Per view the margins at its ranks from below and above, of the documents it has not handed over."""
    columns = []
    for view, ((bad, good), rows) in enumerate(zip(counts, left)):
        # Half a rank inside, so that rounding does not choose a neighbour.
        shares = [min(max((r - 0.5) / max(rows, 1), 0.0), 1.0) for r in (bad, rows - good + 1)]
        open_margin = F.when(F.col(f"given{view}") < 0, F.col(f"margin{view}"))
        columns.append(F.percentile_approx(open_margin, shares, RANK_ACCURACY).alias(f"at{view}"))
    found = _judged(pool, history, models).agg(*columns).first()
    return [tuple(v) if v else None for v in found]


def _taught(pool: DataFrame, history: list[Round], most: int) -> tuple[list[int], list[tuple[np.ndarray, ...]]]:
    """Per view how many documents it hands over in the last round, and the other view's rows and labels of those to fit on.

    About `most` of them at most are drawn, good and bad ones in the proportion in which they were handed over, and evenly from
    languages and sources: a group is drawn whole before a larger one gets more.
    """
    number = len(history) - 1
    choices = F.filter(F.array(*[F.struct(F.lit(v).alias("view"), F.col(f"given{v}").alias("given")) for v in (0, 1)]),
                       lambda c: F.floor(c["given"] / 2) == number)
    chosen = _judged(pool, history, None).select("doc_id", "lang", "src", F.explode(choices).alias("c")).select(
        "doc_id", "lang", "src", "c.view", (F.col("c.given") % 2).alias("label"))
    # At most 2 views, 2 labels, _LANGUAGES languages and _SOURCES sources.
    groups = [g.asDict() for g in chosen.groupBy("view", "label", "lang", "src").count().collect()]
    totals = [sum(g["count"] for g in groups if g["view"] == view) for view in (0, 1)]
    for view, label in {(g["view"], g["label"]) for g in groups}:
        own = [g for g in groups if (g["view"], g["label"]) == (view, label)]
        sizes = [g["count"] for g in own]
        each = level(sizes, max(1, round(min(most, totals[view]) * sum(sizes) / totals[view])))
        for g in own:
            g["each"] = each
    if not groups:
        return totals, [(np.zeros((0, 0)), np.zeros(0))] * 2
    kinds = {"view": "int", "label": "int", "lang": "int", "src": "int", "count": "long", "each": "double"}
    sizes = small_table(pool.sparkSession, {c: [g[c] for g in groups] for c in kinds},
                        ", ".join(f"{c} {kind}" for c, kind in kinds.items()))
    # A row's hash as a share of its group's size is the row's expected rank in the group.
    rank = F.pmod(F.xxhash64("doc_id", F.lit(number)), F.lit(1 << 40)) / float(1 << 40) * F.col("count")
    drawn = chosen.join(F.broadcast(sizes), ["view", "label", "lang", "src"]).where(rank < F.col("each")).orderBy(
        rank / F.col("each"), "doc_id", "view").limit(2 * most).select("doc_id", "view", "label")
    # At most twice `most` rows are broadcast and come to the driver.
    found = pool.join(F.broadcast(drawn), "doc_id").select(
        "doc_id", "content", "lang", "src", "chars", "view", "label").orderBy("doc_id").toArrow()
    views, own, labels = _whole(found), np.asarray(found["view"]), np.asarray(found["label"], dtype=float)
    return totals, [(views[1 - v][own == v], labels[own == v]) for v in (0, 1)]


def _whole(found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    parts = [_matrices(b) for b in found.to_batches() if b.num_rows]
    return tuple(np.concatenate([p[v] for p in parts]) for v in (0, 1))


def cotrain(
    stored: DataFrame, most_labelled: int = MOST_LABELLED, most_taught: int = MOST_TAUGHT, rounds: int = ROUNDS,
    kept_good: float = KEPT_GOOD,
) -> Pair | None:
    """The views fitted on stored features, one row of each doc_id; quality is 1, 0, or -1 for the pool.

    None if a class is missing among the labelled rows to fit on or among those kept back to calibrate on.
    """
    found = stored.where("quality >= 0").orderBy(F.xxhash64("doc_id", F.lit("fit")), "doc_id").limit(most_labelled).toArrow()
    if not found.num_rows:
        return None
    ids = found["doc_id"].to_pylist()
    order = np.array(sorted(range(len(ids)), key=lambda i: str(ids[i])))
    quality = np.asarray(found["quality"])[order]
    held = held_back([ids[i] for i in order], quality)
    if any(len(np.unique(quality[own])) < 2 for own in (~held, held)):
        return None
    views = [x[order] for x in _whole(found)]
    pool = stored.where("quality < 0")
    size, rate = pool.count(), quality[~held].mean()
    # What each view is fitted on: the labelled rows, then what the other view hands over.
    taught = [[(x[~held], quality[~held].astype(float))] for x in views]
    left, history = [size, size], []

    def fitted() -> tuple[Logistic, Logistic]:
        return tuple(fit(np.concatenate([x for x, _ in own]), np.concatenate([y for _, y in own])) for own in taught)

    for _ in range(rounds if int(size * TAUGHT_SHARE) else 0):
        models = fitted()
        counts = [ranks(size, n, rate) for n in left]
        margins = _margins(pool, history, models, counts, left)
        history.append(Round(models, [bounds_of(m, c) for m, c in zip(margins, counts)]))
        totals, drawn = _taught(pool, history, most_taught)
        for view in (0, 1):
            left[view] -= totals[view]
            if len(drawn[view][1]):
                taught[1 - view].append(drawn[view])
        if not any(totals):
            break
    models = fitted()
    y = quality[held].astype(float)
    calibration = tuple(fit(m.margin(x[held])[:, None], y) for m, x in zip(models, views))
    pair = Pair(*models, calibration, float(np.log(y.mean() / (1 - y.mean()))), 0.5)
    p = pair.probabilities(*(x[held] for x in views))[2]
    pair.threshold = float(min(0.5, np.quantile(p[y == 1], 1 - kept_good)))
    return pair


def held_back(ids: list, quality: np.ndarray) -> np.ndarray:
    """The rows to calibrate on: every fourth by hash, and of each class with two rows or more some on either side."""
    held = np.array([zlib.crc32(str(key).encode()) % 4 == 0 for key in ids])
    for label in (0, 1):
        own = np.flatnonzero(quality == label)
        if len(own) > 1 and len(np.unique(held[own])) == 1:
            moved = min(own, key=lambda i: (zlib.crc32(str(ids[i]).encode()), str(ids[i])))
            held[moved] = not held[moved]
    return held


def _view_columns(docs: DataFrame, extra: list[str]) -> DataFrame:
    return docs.select(*extra, F.col("text").alias(TEXT), F.col("lang").cast("string").alias("_lang"),
                       F.col("source").cast("string").alias("_source"), F.col("n_chars").cast("long").alias("_chars"))


def _features(part: pa.RecordBatch, texts: list[bytes], first: int) -> tuple[np.ndarray, np.ndarray]:
    chars = np.asarray(part.column(first + 3).cast(pa.float64()).fill_null(np.nan))
    meta = metadata_features(*places(*(part.column(first + i).to_pylist() for i in (1, 2))), chars)
    return np.stack([content_features(t) for t in texts]), meta


def stored_features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Both views' features of one row of each doc_id that has no label (quality -1) or one of 0 or 1, stored.

    Rows without a doc_id teach nothing. Of rows with the same doc_id one counts; of different labels the smaller.
    """
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                content = np.stack([content_features(t) for t in texts]).astype(np.float32)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(content.ravel()), CONTENT).cast(pa.list_(pa.float32()))
                lang, source = places(*(part.column(i).to_pylist() for i in (2, 3)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), flat, pa.array(lang), pa.array(source), part.column(4)],
                    names=["doc_id", "content", "lang", "src", "chars"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _view_columns(docs.where("doc_id is not null"), ["doc_id"]).mapInArrow(
        mapped, f"doc_id {kind}, content array<float>, lang int, src int, chars long")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("content", "lang", "src", "chars")).alias("r")).select("doc_id", "r.*")
    # Labels of other values leave a document out of both.
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.when(F.col("quality").isin(0, 1), F.col("quality").cast("int"))).alias("quality"), F.lit(True).alias("listed"))
    joined = rows.join(marked, "doc_id", "left").where("listed is null or quality is not null")
    return store(joined.withColumn("quality", F.coalesce("quality", F.lit(-1))).select("doc_id", *_STORED), "features")


#: Columns that the classifier adds.
RESULTS = ("p_content", "p_metadata", "quality_score", "accepted")


def quality_classifier(
    docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, fit_on: DataFrame | None = None, **options,
) -> DataFrame:
    """The rows (columns `keep`, else all) with p_content, p_metadata, quality_score and accepted.

    labels: doc_id and quality (0 or 1; the smaller counts where they differ). All documents are scored, null and empty
    texts by the features of an empty one, long ones whole; an empty table gives no rows. A document is accepted from the
    score on that keeps KEPT_GOOD of the good documents kept back, 0.5 at most. The views are fitted on documents of
    fit_on (docs if none are given). Without two labelled ones of each class the scores are null and all are accepted,
    with a warning. Input columns called like a result give way to it.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    pair = cotrain(stored_features(docs if fit_on is None else fit_on, labels), **options)
    if pair is None:
        warnings.warn("too few labelled documents of a class to fit on: all documents are accepted", stacklevel=2)
        empty = F.lit(None).cast("double")
        return docs.select(*keep, empty.alias("p_content"), empty.alias("p_metadata"), empty.alias("quality_score"),
                           F.lit(True).alias("accepted"))
    n = len(keep)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch.rename_columns([f"c{i}" for i in range(n)] + [TEXT, "l", "s", "c"])):
                scores = pair.probabilities(*_features(part, texts, n))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(n)] + [pa.array(s) for s in scores]
                    + [pa.array(scores[2] >= pair.threshold)], names=[*keep, *RESULTS])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    # Named by place, so that no kept column is called like one that is read.
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(keep)], F.col("text").alias(TEXT),
        F.col("lang").cast("string").alias("_l"), F.col("source").cast("string").alias("_s"),
        F.col("n_chars").cast("long").alias("_c"))
    return rows.mapInArrow(
        mapped, f"{fields}, p_content double, p_metadata double, quality_score double, accepted boolean")
