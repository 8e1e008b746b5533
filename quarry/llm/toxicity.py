"""Toxicity by class-conditional Kneser-Ney models."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.base import carried, give_back, small_batches
from quarry.llm.shingles import Places, batch_word_hashes, mixed

#: Labelled documents per class that the models count, labelled documents of any
#: class, none of them counted, that calibrate the score, and the characters of
#: either kind of sample at most (whole documents).  These bound what the driver holds.
COUNTED, CALIBRATED, MOST_CHARS = 2000, 4000, 1 << 25
#: Characters at the start of a word that its unseen forms share with it.
STEM = 5
#: Log ratios above which what a word says counts, each with a weight of its own.
MARGINS = (1.0, 2.0, 3.0, 4.0)
#: The scale of the excess per word, and the number of a score's features.
EXCESS, FEATURES = 0.02, 1 + len(MARGINS)
#: From this score on a document is predicted to be toxic.
THRESHOLD = 0.3
#: Characters of text, and words of one text, that are worked on together.
BATCH, WORDS = 1 << 19, 1 << 20
_STEP = np.uint64(0x9FB21C651E98DF25)
_BLANK = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def plain(text: str | None) -> bytes:
    """ASCII lower case words without ASCII punctuation, parted by one space."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_BLANK).lower().split())


def _bigrams(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(before * _STEP + word)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[list[np.ndarray]]:
    """Word and stem hashes of the batch's texts, in order, some texts at a time."""
    group: list[bytes] = []
    size = 0
    for at in range(0, batch.num_rows, 128):
        for text in batch.column(column).slice(at, 128).to_pylist():
            if group and size + len(text or "") > BATCH:
                yield list(batch_word_hashes(group, STEM))
                group, size = [], 0
            group.append(plain(text))
            size += len(text or "")
    if group:
        yield list(batch_word_hashes(group, STEM))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (toxic, word, stem, before, ahead): the different words with their
    stem and the two words before (0 where the text begins)."""
    for batch in batches:
        label, at = np.array(batch.column(1).to_pylist()), 0
        for words in _texts(batch, 0):
            here, at = label[at : at + len(words)], at + len(words)
            for toxic in (0, 1):
                own = [w for w, x in zip(words, here) if x == toxic and len(w)]
                if not own:
                    continue
                before = np.concatenate([np.append(np.uint64(0), w[:-1, 0]) for w in own])
                ahead = np.concatenate([np.append(np.zeros(min(2, len(w)), np.uint64), w[:-2, 0]) for w in own])
                rows = np.column_stack((np.concatenate(own), before, ahead))
                key = _bigrams(_bigrams(rows[:, 3], rows[:, 2]), rows[:, 0])
                rows = rows[np.unique(key, return_index=True)[1]]
                yield pa.record_batch(
                    [pa.array(np.full(len(rows), toxic, np.int32))]
                    + [pa.array(np.ascontiguousarray(rows[:, i]).view(np.int64)) for i in range(4)],
                    ["toxic", "word", "stem", "before", "ahead"],
                )


COUNTS = "toxic int, word long, stem long, before long, ahead long"


class Model:
    """Two interpolated bigram models, ordinary (0) and toxic (1), and that of both
    together (2).  The last place of a table is what was never counted.

    ``tables``: words and stems (sorted hashes); word_p (3, words): probability of
    the word; unseen_p (3, stems + 1): that of an unseen form of the stem; pairs
    (sorted hashes of two words) and pair_p (3, pairs + 1): discounted share of
    the pair among those of its first word; backoff (3, words + 1): what the
    pairs of a first word leave; level (2, words + 1): that the shared pairs,
    weighed by a class's words, sum to.
    """

    def __init__(self, tables: dict, weights: np.ndarray):
        self.tables, self.weights = tables, weights
        if "find" not in tables:  # kept with the tables, which a worker loads once
            tables["find"] = {n: Places(tables[n]) for n in ("words", "stems", "pairs")}
        self.find = {n: p.find for n, p in tables["find"].items()}

    def singles(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words, and their probabilities by class without what stands before."""
        t = self.tables
        at = self.find["words"](h[:, 0])
        p = np.empty((3, len(h)))
        known = at < len(t["words"])
        p[:, known] = t["word_p"][:, at[known]]
        p[:, ~known] = t["unseen_p"][:, self.find["stems"](h[~known, 1])]
        return at, p

    def probabilities(self, h: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(2, words): of each word after the one before it, in either class; where a
        text starts, of the word by itself."""
        t = self.tables
        at, p = self.singles(h)
        after = np.flatnonzero(~starts)
        v, w = at[after - 1], at[after]
        pair = np.full(len(after), len(t["pairs"]), np.int64)
        both = np.flatnonzero((v < len(t["words"])) & (w < len(t["words"])))
        i = after[both]
        pair[both] = self.find["pairs"](_bigrams(h[i - 1, 0], h[i, 0]))
        # a class's bigrams back off to those of both, as much more or less likely
        # as the class makes the word, and both to the class's words
        shared = t["pair_p"][2, pair] / p[2, after] + t["backoff"][2, v]
        p[:2, after] = t["pair_p"][:2, pair] + t["backoff"][:2, v] * shared * p[:2, after] / t["level"][:, v]
        return p[:2]

    def ratios(self, h: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
        """Log likelihood ratio of each word, toxic to ordinary."""
        if starts is None:
            starts = np.arange(len(h)) == 0
        out = [np.zeros(0)]
        for i in range(0, len(h), WORDS):
            first = max(i - 1, 0)
            p = self.probabilities(h[first : i + WORDS], np.append(True, starts[first + 1 : i + WORDS]))
            out.append(np.log(p[1, i - first :] / p[0, i - first :]))
        return np.concatenate(out)

    def features(self, words: list[np.ndarray]) -> np.ndarray:
        """Per text: the mean log ratio of its words, and the mean excess over each of
        MARGINS.  All of them are means over the words, whatever their number."""
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        h = np.concatenate(words) if len(words) else np.zeros((0, 2), np.uint64)
        starts = np.zeros(len(h), bool)
        starts[(ends - sizes)[sizes > 0]] = True
        r = self.ratios(h, starts)
        mean = lambda x: np.diff(np.append(0.0, np.append(0.0, np.cumsum(x))[ends])) / np.maximum(sizes, 1)
        excess = [np.log1p(np.maximum(mean(np.maximum(r - k, 0.0)), 0.0) / EXCESS) for k in MARGINS]
        return np.column_stack([mean(r), *excess])

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)))


def held_out():
    """The fold whose labels are never learnt from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def labelled(
    docs: DataFrame, labels: DataFrame, counted: int = COUNTED, calibrated: int = CALIBRATED, most_chars: int = MOST_CHARS
) -> tuple[DataFrame, DataFrame]:
    """Bounded samples (text, toxic): those to count, and those to calibrate on."""
    known = (
        labels.select("doc_id", "toxic")
        .where("doc_id is not null and toxic in (0, 1)")
        .where(~held_out())
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("draw", F.xxhash64("doc_id", F.lit(9)))
    )
    fold = F.pmod("draw", F.lit(3))
    pick = lambda rows, n: rows.orderBy("draw", "doc_id").limit(n)
    toxic = known.where((fold > 0) & (F.col("toxic") == 1))
    # as many of either class: else every new word would speak for the smaller one
    n = min(counted, toxic.limit(counted).count())
    picked = pick(toxic, n).union(pick(known.where((fold > 0) & (F.col("toxic") == 0)), n))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    upto = Window.partitionBy("toxic").orderBy("draw", "doc_id", "n")

    def sample(ids: DataFrame) -> DataFrame:
        # at most 2 * counted or calibrated ids of 16 bytes: small enough to broadcast
        rows = texts.join(F.broadcast(ids.select("doc_id", "toxic", "draw")), "doc_id").withColumn("n", F.length("text"))
        return rows.withColumn("upto", F.sum("n").over(upto)).where(F.col("upto") <= most_chars).select("text", "toxic")

    return sample(picked), sample(pick(known.where(fold == 0), calibrated))


def discounts(n1: float, n2: float, n3: float, n4: float) -> np.ndarray:
    """Kneser-Ney's D1, D2 and D3+ at places 1 to 3 (0 at place 0), from how many
    counts are 1, 2, 3 and 4; whatever the size of the sample they are below their
    count.  Where one of these is missing the plain discount stands in, and one
    half where nothing was counted once or twice."""
    n = (0, n1, n2, n3, n4)
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    own = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] and n[k + 1] else y for k in (1, 2, 3)]
    return np.array([0.0, *(float(d) if 0 < d < k else y for k, d in zip((1, 2, 3), own))])


def taken(counts: np.ndarray) -> np.ndarray:
    """What the discounts estimated from these counts take of each."""
    d = discounts(*(int((counts == k).sum()) for k in (1, 2, 3, 4)))
    return d.astype(np.float32)[np.minimum(counts, 3).astype(np.int8)]


def _arrays(df: DataFrame) -> dict[str, np.ndarray]:
    """The columns, without a copy as pandas."""
    table = df.toArrow()
    return {c: table.column(c).to_numpy() for c in table.column_names}


def _frequencies(known) -> Callable:
    """Rows (place, n): in how many texts each known word, unseen form of a known
    stem, and unseen stem stands, summed over the task's texts."""

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, stems = (Places(x) for x in known.value)
        total = np.zeros(len(words.keys) + len(stems.keys) + 1, np.int64)
        for batch in batches:
            for own in _texts(batch, 0):
                h = np.concatenate(own)
                text = np.repeat(np.arange(len(own), dtype=np.uint64), [len(w) for w in own])
                h = h[np.unique(_bigrams(text, h[:, 0]), return_index=True)[1]]
                at = words.find(h[:, 0])
                new = at == len(words.keys)
                at[new] += stems.find(h[new, 1])
                total += np.bincount(at, minlength=len(total))
        hit = np.flatnonzero(total)
        yield pa.record_batch([pa.array(hit), pa.array(total[hit])], ["place", "n"])

    return lambda batches: give_back(frequencies(batches))


def tables_of(t: dict[str, np.ndarray], frequencies: Callable) -> dict:
    """The models' tables, from counts per (word, stem, before), which it uses up, and
    a function that tells in how many texts of the corpus given words and stems stand."""
    as_hash = lambda c: t[c].view(np.uint64)
    words, first, w = np.unique(as_hash("word"), return_index=True, return_inverse=True)
    stems, st = np.unique(as_hash("stem")[first], return_inverse=True)
    del t["word"], t["stem"], first
    per_word, per_stem = (lambda x, i=i, n=n: np.bincount(i, x, n) for i, n in ((w, len(words)), (st, len(stems))))
    n = np.stack([t.pop(f"n{c}") for c in range(3)])
    # what stands before a word counts, not how often it is there, so that copies
    # and passages count once
    word = np.stack([per_word(x > 0) for x in n])
    stem = np.stack([per_stem(x) for x in word])
    # the shared level: contexts in the sample and, with as much weight, texts of
    # all the corpus; one half of a form, and of a stem, for those never seen
    seen = frequencies(words, stems)
    scale = word[2].sum() / max(seen.sum(), 1)
    in_word, in_form, in_none = np.split(seen * scale, [len(words), len(words) + len(stems)])
    shared_word = word[2] + in_word
    shared_stem = per_stem(shared_word) + in_form
    forms = shared_stem + 0.5 * (np.bincount(st, minlength=len(stems)) + 1)
    share = (shared_word + 0.5) / forms[st]
    unseen = np.append((in_form + 0.5) / forms, 1.0)
    shared = np.append(shared_stem, in_none) + 0.5
    shared /= shared.sum()
    total = np.maximum(word.sum(axis=1), 1)
    left = lambda less, counts: np.where(counts.any(axis=1), less.sum(axis=1) / total, 1.0)[:, None]
    less = np.stack([taken(x) for x in stem])
    stem_p = left(less, stem) * shared
    stem_p[:, :-1] += (stem - less) / total[:, None]
    less = np.stack([taken(x) for x in word])
    rest = left(less, word)
    word_p = (word - less) / total[:, None] + rest * stem_p[:, st] * share
    # pairs; no word stands before 0, where a text begins
    inside = np.flatnonzero(as_hash("before") != 0)
    v, w, n = np.searchsorted(words, as_hash("before")[inside]).astype(np.int32), w[inside].astype(np.int32), n[:, inside]
    t.clear()
    pairs = _bigrams(words[v], words[w])
    order = np.argsort(pairs)
    pairs, v, w, n = pairs[order], v[order], w[order], n[:, order]
    del inside, order
    pair_p = np.zeros((3, len(pairs) + 1), np.float32)
    backoff, level = np.ones((3, len(words) + 1)), np.ones((2, len(words) + 1))
    for c in range(3):
        mass, less = np.bincount(v, n[c], len(words)), taken(n[c])
        free = np.bincount(v, less, len(words))
        backoff[c, :-1] = np.where(mass > 0, free / np.maximum(mass, 1), 1.0)
        pair_p[c, :-1] = (n[c] - less) / np.maximum(mass, 1)[v]
    for c in (0, 1):
        level[c, :-1] = np.bincount(v, pair_p[2, :-1] * (word_p[c] / word_p[2])[w], len(words)) + backoff[2, :-1]
    return {
        "words": words, "stems": stems, "pairs": pairs, "word_p": word_p,
        "unseen_p": rest * stem_p * unseen, "pair_p": pair_p, "backoff": backoff, "level": level,
    }


def fit(docs: DataFrame, labels: DataFrame, counted: int = COUNTED, calibrated: int = CALIBRATED, most_chars: int = MOST_CHARS):
    """Count and calibrate; returns the broadcast tables and the weights.

    Spark sums the counts of the labelled sample, whose size the parameters bound,
    and in how many texts of all documents its words and stems stand."""
    spark = docs.sparkSession
    small_batches(spark)
    sample, other = labelled(docs, labels, counted, calibrated, most_chars)
    seen = [F.max((F.col("toxic") == c).cast("int")).alias(f"n{c}") for c in (0, 1)]
    sums = [F.sum(f"n{c}").cast("int").alias(f"n{c}") for c in (0, 1)]
    counts = _arrays(
        sample.mapInArrow(_count, COUNTS).groupBy("word", "stem", "before", "ahead").agg(*seen)
        .groupBy("word", "stem", "before").agg(*sums, F.count("*").cast("int").alias("n2"))
    )

    def frequencies(words: np.ndarray, stems: np.ndarray) -> np.ndarray:
        known = spark.sparkContext.broadcast((words, stems))
        rows = _arrays(
            docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_frequencies(known), "place long, n long")
            .groupBy("place").agg(F.sum("n").alias("n"))
        )
        known.destroy()
        total = np.zeros(len(words) + len(stems) + 1)
        total[rows["place"]] = rows["n"]
        return total

    tables = tables_of(counts, frequencies)
    held = spark.sparkContext.broadcast(tables)
    names = [f"f{i}" for i in range(FEATURES)]
    rows = _arrays(other.select(F.col("toxic").cast("double").alias("toxic"), "text").mapInArrow(
        _features(held, ["toxic"], 1), ", ".join(["toxic double", *(f"{x} double" for x in names)])
    ))
    return held, calibrate(np.column_stack([rows[x] for x in names]), rows["toxic"])


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge; a weight that would
    be negative is 0, so that no likelihood speaks against its class.  With one
    class only, the score is a prior."""
    out = np.zeros(x.shape[1] + 1)
    if len(y) == 0 or y.min() == y.max():
        out[0] = -3.0
        return out
    spread = x.std(axis=0)
    used = np.flatnonzero(spread > 0)
    while True:
        z = np.column_stack((np.ones(len(x)), x[:, used] / spread[used]))
        w, ridge = np.zeros(z.shape[1]), np.eye(z.shape[1]) * 1e-2
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
            w += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        if (w[1:] >= 0).all():
            break
        used = np.delete(used, np.argmin(w[1:]))
    out[0], out[1 + used] = w[0], w[1:] / spread[used]
    return out


def _features(held, keep: list[str], text: int) -> Callable:
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(held.value, np.zeros(0))
        for batch in batches:
            x = [model.features(words) for words in _texts(batch, text)] or [np.zeros((0, FEATURES))]
            x = np.concatenate(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns) if i != text]
                + [pa.array(np.ascontiguousarray(x[:, i])) for i in range(FEATURES)],
                names=[*keep, *(f"f{i}" for i in range(FEATURES))],
            )

    return features


def _score(held, weights: np.ndarray, whole: bool) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(held.value, weights)
        for batch in batches:
            scores = [model.scores(model.features(words)) for words in _texts(batch, 1)] or [np.zeros(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns) if whole or i != 1] + [pa.array(np.concatenate(scores))],
                names=[*(n for i, n in enumerate(batch.schema.names) if whole or i != 1), "score"],
            )

    return lambda batches: give_back(score(batches))


def toxicity(docs: DataFrame, labels: DataFrame, whole: bool = False, model=None, **bounds) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document and, with ``whole``, ``row``:
    all its columns as a struct.

    Two bigram models, of toxic and of ordinary documents, with interpolated
    Kneser-Ney smoothing, whose discounts are estimated at each level from counts
    of counts.  A class's discounted bigrams back off to those of both classes,
    reweighted by the class's words; its words back off to stems, and these to
    counts that both share: contexts in the sample, and in how many texts of all
    documents a word stands.  So a rare expression says as much as has been
    counted of it in either class, against what the corpus lets expect.

    The log likelihoods of the two classes are compared word by word and averaged
    over the words, so that length doesn't count.  The score is a logistic
    function of the mean ratio and of the mean excess over each of ``MARGINS``:
    most of a toxic document reads like any other, and small ratios come by
    chance.  Its weights, none of them negative, are fitted on labelled documents
    that the models haven't counted, and keep false alarms few.

    Labels are used only from documents outside the held-out fold; text is the
    only input of a score.  ``bounds`` (``counted, calibrated, most_chars``) limit
    the labelled documents that ``fit`` learns from, whole documents each, and
    with them what the driver holds and broadcasts; the shared counts read all
    documents.  Scoring is one pass without a shuffle, some words at a time, so
    that very long texts need no more memory than their own hashes.

    Defined cases: null and empty texts score as having no evidence; a null id
    is not held out; equal texts, and rows repeated under one id, score alike;
    repeated label rows count once, toxic if any says so; without labels of both
    classes the score is a fixed prior; an empty table gives no rows; other
    columns, whatever their names, are read only for ``whole``.
    """
    small_batches(docs.sparkSession)
    held, weights = model or fit(docs, labels, **bounds)
    others = [c for c in docs.columns if whole and c not in ("doc_id", "text")]
    there, back = carried(others)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *there)
    kept = rows.columns if whole else [c for c in rows.columns if c != "text"]
    schema = rows.select(*kept).schema.add("score", "double")
    scored = rows.mapInArrow(_score(held, weights, whole), schema)
    named = dict(zip(others, back)) | {c: F.col(c).cast(docs.schema[c].dataType) for c in ("doc_id", "text") if whole}
    row = [F.struct(*(named[c].alias(c) for c in docs.columns)).alias("row")] if whole else []
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        *row,
    )
