"""SentencePiece encoding with seeded merge-dropout, and decoding."""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from quarry.llm.base import carried, give_back, small_batches
from quarry.llm.shingles import Places, mixed

#: A public BPE model with byte fallback; read on the driver only.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Share of candidate merges that are skipped.
DROPOUT, SEED = 0.1, 42
#: No piece has a space after another character, so segments are independent.
SEGMENT = re.compile(" *[^ ]+| +")
#: Characters of a segment from which on it is cut between characters that no
#: piece holds side by side, and what is still longer is segmented by itself.
LONG = 256
#: Characters of text segmented together.
BATCH = 1 << 20
#: Segmentations, and segments met once, that a task keeps.
HELD, MET = 200_000, 500_000
_NEVER = np.int32(2**31 - 1)
_U = np.uint64
_ALL = (1 << 64) - 1
#: Odd, so that multiplying by it spreads keys and loses none.
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_REPLACED = "\ufffd".encode()


def load(path: str = MODEL) -> dict:
    """The model's pieces as plain tables: text to id (a space for the model's
    space mark), merge order by id, bytes, and merges of two ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, order_of, byte_ids, plain = {}, np.zeros(len(model), np.int64), [0] * 256, [b""] * len(model)
    for i in range(len(model)):
        text = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(text[3:5], 16)] = i
            plain[i] = bytes([int(text[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            text = text.replace("▁", " ")
            pieces[text] = i
            plain[i] = text.encode()
            order_of[i] = round(-model.get_score(i) * 16)  # BPE scores count merges
    merges = {
        (pieces[text[:cut]], pieces[text[cut:]]): i
        for text, i in pieces.items()
        for cut in range(1, len(text))
        if text[:cut] in pieces and text[cut:] in pieces
    }
    keys = np.array([a << 32 | b for a, b in merges], dtype=np.uint64) * _SPREAD
    order = np.argsort(keys)
    by_point = np.full(0x110000, -1, dtype=np.int32)
    for t, i in pieces.items():
        if len(t) == 1:
            by_point[ord(t)] = i
    beside = {t[i : i + 2] for t in pieces for i in range(len(t) - 1)}
    return {
        "pieces": pieces,
        "beside": beside,
        "by_point": by_point,
        "rank": np.unique(order_of, return_inverse=True)[1].astype(np.int32),
        "bytes": byte_ids,
        "plain": plain,
        "pairs": Places(keys[order]),
        # the piece of the pair at each place, and 0 with no rank for what is no pair
        "merged": np.append(np.array(list(merges.values()), dtype=np.int32)[order], 0),
    }


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _starts(flat: str, points: np.ndarray, heads: np.ndarray, beside: set[str]) -> np.ndarray:
    """Where segments start in texts put one after another, each with a space before
    it: there, where spaces begin, and, in long ones, between characters that no
    piece holds side by side."""
    space = points == 32
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[heads] = True
    starts = np.flatnonzero(first)
    size = np.diff(np.append(starts, len(points)))
    if len(size) and size.max() > LONG:
        cuts = [starts]
        for i in np.flatnonzero(size > LONG):
            at, end = int(starts[i]), int(starts[i] + size[i])
            cuts.append(np.array([k for k in range(at + 1, end) if flat[k - 1 : k + 1] not in beside], np.int64))
        starts = np.sort(np.concatenate(cuts))
    return starts


def segments(text: str, model: dict) -> list[str]:
    """The text, a space before it, in parts that no piece crosses."""
    if not text:
        return []
    flat = " " + text
    starts = _starts(flat, code_points(flat), np.zeros(1, np.int64), model["beside"]).tolist()
    return [flat[a:b] for a, b in zip(starts, [*starts[1:], len(flat)])]


def skipped(key, start, end, dropout: float):
    """Whether the keyed hash skips the merge that spans these characters."""
    h = mixed(np.asarray(key).astype(_U) ^ mixed((np.asarray(start).astype(_U) << _U(32)) + np.asarray(end).astype(_U)))
    return (h >> _U(11)) < _U(int(dropout * 2**53))


def _mix(x: int) -> int:
    """``mixed`` of one number."""
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _ALL
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _ALL
    return x ^ (x >> 31)


def segment_ids(segment: str, key: int, model: dict, dropout: float) -> list[int]:
    """One segment by an agenda of candidate merges: best score first, leftmost
    of equal ones; a candidate that its hash skips is dropped when it comes up.
    Its steps grow with the segment's length, but for the agenda's logarithm."""
    pieces, rank, key, least = model["pieces"], model["rank"].tolist(), int(key), int(dropout * 2**53)
    text = list(segment)
    before = list(range(-1, len(text) - 1))
    after = [*range(1, len(text)), -1]
    agenda: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if i >= 0 and j >= 0:
            both = pieces.get(text[i] + text[j])
            if both is not None:
                heapq.heappush(agenda, (rank[both], i, len(text[i]), len(text[j])))

    for i in range(len(text) - 1):
        offer(i)
    while agenda:
        _, i, n, m = heapq.heappop(agenda)
        j = after[i]
        if text[i] is None or len(text[i]) != n or j < 0 or len(text[j]) != m:
            continue  # one of its sides has been merged meanwhile
        if dropout and _mix(key ^ _mix((i << 32) + i + n + m)) >> 11 < least:
            continue
        text[i] += text[j]
        text[j] = None
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    ids: list[int] = []
    for t in text:
        if t is not None:
            known = pieces.get(t)
            ids += [known] if known is not None else [model["bytes"][b] for b in t.encode("utf-8", "surrogatepass")]
    return ids


def occurrence_keys(docs: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A key for each segment, from its document's and its place in the text."""
    return mixed(mixed(docs) + places.astype(_U))


def document_key(doc_id: int | None, copy: int, seed: int) -> int:
    return xxhash.xxh64_intdigest(f"{doc_id} {copy}".encode(), seed=seed)


def _spans(seg, start, end):
    """A segment's number and a span in it (of at most LONG characters) as one number."""
    return (seg << 24) + (start << 12) + end


def batch_ids(
    segments: list[str], model: dict, barred: np.ndarray | None = None, keys: np.ndarray | None = None, dropout: float = 0.0
) -> tuple[np.ndarray, np.ndarray, list]:
    """All segments at once: flat ids, their number per segment, and arrays
    (segment, start, end) of the merges made, in the order of each segment's agenda.
    Candidates that come up are skipped if they are in ``barred`` (sorted
    ``_spans``) or, where ``keys`` are given, by the segment's key.

    The agenda in steps: every unfinished segment takes its best candidate in
    each step, all of them together as array operations."""
    n = len(segments)
    sizes = np.fromiter(map(len, segments), np.int64, n)
    flat = "".join(segments)
    points = code_points(flat)
    sym = model["by_point"][points]
    seg = np.repeat(np.arange(n), sizes)
    starts = np.cumsum(sizes) - sizes
    pos = (np.arange(len(flat)) - np.repeat(starts, sizes)).astype(np.int32)
    length = np.ones(len(flat), dtype=np.int32)
    merges: list = []

    def candidates(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of merging the symbols at left with those at right."""
        known = np.flatnonzero((sym[left] >= 0) & (sym[right] >= 0))
        a, b = sym[left[known]].astype(_U), sym[right[known]].astype(_U)
        at = model["pairs"].find(((a << _U(32)) | b) * _SPREAD)
        good = at < len(model["pairs"].keys)
        known, at = known[good], at[good]
        if len(known) and (keys is not None or barred is not None and len(barred)):
            l, r = left[known], right[known]
            end = pos[r] + length[r]
            if keys is not None:
                stays = ~skipped(keys[seg[l]], pos[l], end, dropout)
            else:
                span = _spans(seg[l], pos[l], end)
                stays = barred[np.minimum(np.searchsorted(barred, span), len(barred) - 1)] != span
            known, at = known[stays], at[stays]
        piece, rank = np.zeros(len(left), np.int32), np.full(len(left), _NEVER, np.int32)
        piece[known] = model["merged"][at]
        rank[known] = model["rank"][piece[known]]
        return rank, piece

    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rank = np.full(len(sym), _NEVER, np.int32)
    piece = np.zeros(len(sym), dtype=np.int32)
    if len(sym) > 1:
        inside = np.flatnonzero(seg[:-1] == seg[1:])
        rank[inside], piece[inside] = candidates(inside, inside + 1)
    while len(sym):
        heads = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
        best = np.minimum.reduceat(rank, heads)
        live = best < _NEVER
        counts = np.diff(np.append(heads, len(sym)))
        if not live.all():
            out = np.repeat(~live, counts)
            done.append((seg[out], pos[out], sym[out]))
            keep = ~out
            sym, seg, pos, length, rank, piece = (x[keep] for x in (sym, seg, pos, length, rank, piece))
            if not len(sym):
                break
            counts, best = counts[live], best[live]
            heads = np.cumsum(counts) - counts
        hit = np.flatnonzero(rank == np.repeat(best, counts))
        hit = hit[np.concatenate(([True], seg[hit][1:] != seg[hit][:-1]))]  # leftmost
        merges.append((seg[hit], pos[hit], pos[hit + 1] + length[hit + 1]))
        sym[hit] = piece[hit]
        length[hit] += length[hit + 1]
        keep = np.ones(len(sym), dtype=bool)
        keep[hit + 1] = False
        at = hit - np.arange(len(hit))  # after the removal of one symbol before each
        sym, seg, pos, length, rank, piece = (x[keep] for x in (sym, seg, pos, length, rank, piece))
        rank[at] = _NEVER
        for left in (at, at - 1):
            left = left[(left >= 0) & (left + 1 < len(sym))]
            left = left[seg[left] == seg[left + 1]]
            rank[left], piece[left] = candidates(left, left + 1)
    if not done:
        return np.zeros(0, np.int64), np.zeros(n, np.int64), merges
    seg, pos, sym = (np.concatenate(x) for x in zip(*done))
    order = np.lexsort((pos, seg))
    seg, pos, sym = seg[order], pos[order], sym[order]
    unknown = np.flatnonzero(sym < 0)
    if len(unknown):
        spelt = [flat[starts[seg[u]] + pos[u]].encode("utf-8", "surrogatepass") for u in unknown]
        times = np.ones(len(sym), dtype=np.int64)
        times[unknown] = [len(b) for b in spelt]
        bytes_at = np.repeat(sym < 0, times)
        seg, sym = np.repeat(seg, times), np.repeat(sym, times)
        sym[bytes_at] = np.array(model["bytes"])[np.frombuffer(b"".join(spelt), np.uint8)]
    return sym, np.bincount(seg, minlength=n), merges


def decode_ids(ids: list[int], model: dict) -> str:
    """The text: pieces and bytes in order, without the space put before it.  What
    isn't UTF-8, or no id of the model, is a replacement character."""
    plain = model["plain"]
    try:
        whole = b"".join(map(plain.__getitem__, ids)) if min(ids, default=0) >= 0 else None
    except IndexError:
        whole = None
    if whole is None:
        whole = b"".join(plain[i] if 0 <= i < len(plain) else _REPLACED for i in ids)
    try:
        return whole[1:].decode("utf-8", "surrogatepass")
    except UnicodeDecodeError:
        return whole[1:].decode("utf-8", "replace")


class _Column:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.held, self.n = np.zeros(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.held):
            self.held = np.concatenate((self.held[: self.n], np.zeros(max(self.n, len(more)), self.held.dtype)))
        self.held[self.n : self.n + len(more)] = more
        self.n += len(more)


class Segmenter:
    """Segments met in a task, as trees of what their agendas do.

    A root has the ids and, in order, the merges of a segment that skips none.
    Each occurrence draws for itself: the first merge that its key skips leads to
    a branch, whose ids and further merges are those of the agenda without it,
    and so on until no merge is skipped.  Branches are made when they are first
    needed and depend on what is skipped alone, so they serve all occurrences.
    At HELD of them the trees start anew."""

    def __init__(self, model: dict, dropout: float):
        self.model, self.dropout = model, dropout
        self.clear()

    def clear(self) -> None:
        self.roots: dict[int, int] = {}  # by hash of the segment; -1 for one met once
        self.names: list[str] = []
        self.skips: list[tuple] = []  # the spans that a node's agenda skips
        self.ids, self.start, self.end, self.branch = (_Column(np.int32) for _ in range(4))
        # of nodes: where ids and merges are, and how many; merges made before its last skip
        self.at, self.count, self.first, self.merges, self.made = (_Column(np.int64) for _ in range(5))

    def _learn(self, names: list[str], skips: list[tuple], made: np.ndarray) -> None:
        """Nodes of these segments with these skips; ``made`` merges come before the last."""
        barred = np.sort(np.array([_spans(i, *x) for i, spans in enumerate(skips) for x in spans], np.int64))
        ids, counts, merges = batch_ids(names, self.model, barred)
        seg, start, end = (np.concatenate(x) for x in zip(*merges)) if merges else (np.zeros(0, np.int64),) * 3
        order = np.argsort(seg, kind="stable")
        total = np.bincount(seg, minlength=len(names))
        order = order[np.arange(len(order)) - np.repeat(np.cumsum(total) - total, total) >= np.repeat(made, total)]
        left = total - made
        self.at.add(self.ids.n + np.cumsum(counts) - counts)
        self.count.add(counts)
        self.first.add(self.start.n + np.cumsum(left) - left)
        self.merges.add(left)
        self.made.add(made)
        self.ids.add(ids)
        self.start.add(start[order])
        self.end.add(end[order])
        self.branch.add(np.full(len(order), -1))
        self.names += names
        self.skips += skips

    def _branches(self, node: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """The nodes that follow when these nodes skip these merges."""
        new, first = np.unique(edge, return_index=True)
        need = self.branch.held[new] < 0
        new, parent = new[need], node[first[need]]
        if len(new):
            spans = zip(self.start.held[new].tolist(), self.end.held[new].tolist())
            known = len(self.names)
            made = self.made.held[parent] + new - self.first.held[parent]
            self._learn(
                [self.names[p] for p in parent], [(*self.skips[p], x) for p, x in zip(parent, spans)], made
            )
            self.branch.held[new] = known + np.arange(len(new))
        return self.branch.held[edge]

    def _roots(self, flat: str, starts: np.ndarray, ends: np.ndarray, names: np.ndarray) -> np.ndarray:
        """The root of each segment, known by the hash of its characters; -1 for one
        met for the first time, and once, which isn't worth a tree yet."""
        unique, first, inverse, times = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
        unique = unique.tolist()
        node = np.fromiter(map(self.roots.get, unique, itertools.repeat(-2)), np.int64, len(unique))
        node[(node == -1) | (node == -2) & (times > 1)] = -3
        new, once = np.flatnonzero(node == -3), np.flatnonzero(node == -2)
        if len(new):
            node[new] = len(self.names) + np.arange(len(new))
            self.roots.update((unique[i], n) for i, n in zip(new.tolist(), node[new].tolist()))
            own = [flat[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            self._learn(own, [()] * len(own), np.zeros(len(own), np.int64))
        node[once] = -1
        self.roots.update((unique[i], -1) for i in once.tolist())
        return node[inverse]

    def encode(self, flat: str, points: np.ndarray, starts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the segments that start there, under these keys, and their numbers."""
        if len(self.names) > HELD:
            self.clear()
        elif len(self.roots) > len(self.names) + MET:
            self.roots = {k: n for k, n in self.roots.items() if n >= 0}
        ends = np.append(starts[1:], len(points))
        size = ends - starts
        place = np.arange(len(points)) - np.repeat(starts, size)
        node = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(size <= LONG)
        if len(short):
            names = np.add.reduceat(mixed(points.astype(_U) + (place.astype(_U) << _U(32))), starts)
            node[short] = self._roots(flat, starts[short], ends[short], names[short])
        live = np.flatnonzero(node >= 0) if self.dropout else np.zeros(0, np.int64)
        while len(live):
            n = self.merges.held[node[live]]
            which = np.repeat(np.arange(len(live)), n)
            at = np.repeat(self.first.held[node[live]] - (np.cumsum(n) - n), n) + np.arange(len(which))
            hit = np.flatnonzero(skipped(keys[live[which]], self.start.held[at], self.end.held[at], self.dropout))
            who = which[hit]
            hit = hit[np.append(True, who[1:] != who[:-1])] if len(hit) else hit
            live = live[which[hit]]
            node[live] = self._branches(node[live], at[hit])
        begin, counts, ids = self.at.held[node], self.count.held[node], self.ids.held[: self.ids.n]
        alone = np.flatnonzero(node < 0)
        if len(alone):
            short, long = alone[size[alone] <= LONG], alone[size[alone] > LONG]
            own = lambda some: [flat[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist())]
            drawn = {"keys": keys[short], "dropout": self.dropout} if self.dropout else {}
            more, n, _ = batch_ids(own(short), self.model, **drawn)
            each = [segment_ids(s, k, self.model, self.dropout) for s, k in zip(own(long), keys[long])]
            n = np.concatenate((n, np.array([len(x) for x in each], np.int64)))
            alone = np.concatenate((short, long))
            counts[alone], begin[alone] = n, len(ids) + np.cumsum(n) - n
            ids = np.concatenate((ids, more, *(np.array(x, np.int32) for x in each)))
        upto = np.cumsum(counts)
        total = int(upto[-1]) if len(upto) else 0
        return ids[np.repeat(begin - (upto - counts), counts) + np.arange(total)], counts

    def texts(self, texts: list[str], docs: list[int]) -> list[np.ndarray]:
        """Ids of each text, whose document's key is given."""
        flat = "".join(" " + t for t in texts if t)
        if not flat:
            return [np.zeros(0, np.int32)] * len(texts)
        points = code_points(flat)
        size = np.array([len(t) + 1 if t else 0 for t in texts])
        heads = np.cumsum(size) - size
        starts = _starts(flat, points, heads[size > 0], self.model["beside"])
        upto = np.searchsorted(starts, heads + size)
        segments = np.diff(np.append(0, upto))
        place = np.arange(len(starts)) - np.repeat(upto - segments, segments)
        keys = occurrence_keys(np.repeat(np.array(docs, _U), segments), place)
        parts = [np.zeros(0, np.int32)]
        counts = [np.zeros(0, np.int64)]
        for i in range(0, len(starts), BATCH // 2):  # more than one part in very long texts only
            some = starts[i : i + BATCH // 2]
            end = starts[i + BATCH // 2] if i + BATCH // 2 < len(starts) else len(flat)
            ids, n = self.encode(flat[some[0] : end], points[some[0] : end], some - some[0], keys[i : i + BATCH // 2])
            parts.append(ids)
            counts.append(n)
        ends = np.append(0, np.cumsum(np.concatenate(counts)))[upto]
        return np.split(np.concatenate(parts), ends[:-1])


def _encode(model, dropout: float, seed: int) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Segmenter(model.value, dropout)
        for batch in batches:
            sizes = np.array([len(t or "") for t in batch.column(1).to_pylist()])
            for part in _parts(sizes):
                own = batch.slice(part.start, len(part))
                texts = [t or "" for t in own.column(1).to_pylist()]
                keys = [document_key(i, c, seed) for i, c in zip(own.column(0).to_pylist(), own.column(2).to_pylist())]
                yield _encoded(own, texts, store.texts(texts, keys), model.value)
        store.clear()

    return lambda batches: give_back(encode(batches))


def _encoded(own: pa.RecordBatch, texts: list[str], ids: list[np.ndarray], model: dict) -> pa.RecordBatch:
    """The batch without text and copy, with the ids and whether they give the text."""
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
    same = [decode_ids(x.tolist(), model) == t for x, t in zip(ids, texts)]
    return pa.RecordBatch.from_arrays(
        [own.column(i) for i in range(own.num_columns) if i not in (1, 2)] + [lists, pa.array(same, pa.bool_())],
        names=["doc_id", *own.schema.names[3:], "token_ids", "lossless"],
    )


def _parts(sizes: np.ndarray, most: int = BATCH) -> Iterator[range]:
    """Runs of rows of at most so many characters, or one longer row."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield range(start, i)
            start, held = i, 0
        held += n
    if len(sizes) > start:
        yield range(start, len(sizes))


def encode(
    docs: DataFrame,
    dropout: float = DROPOUT,
    seed: int = SEED,
    model_path: str = MODEL,
    carry: tuple[str, ...] = (),
    copy: str | None = None,
) -> DataFrame:
    """``doc_id, n_tokens, token_ids, lossless`` (and ``carry``) per document.

    Byte-pair segmentation by an agenda of candidate merges, best score first.
    A hash keyed by the seed, the document's id, its number in the column
    ``copy``, the place of the segment in the text and the merge's span skips a
    candidate with probability ``dropout`` when it comes up, so that every
    occurrence of a word draws for itself; the same seed gives the same ids.
    Without dropout the ids are the model's own.  Characters without a piece are
    spelt in bytes, and so is a literal space mark, so every text decodes to
    itself: ``lossless`` says that it did.

    The model's tables are broadcast: their size is the vocabulary's.  No
    shuffle; a task keeps what segments become under the skips it has met.

    Defined cases: null and empty texts have no tokens; a null id has a key
    like any other; repeated rows of one copy number are encoded alike; a very
    long text is encoded in parts cut between words, and a very long word by an
    agenda of its own, in steps that grow with its length; an empty table gives
    no rows; other columns, whatever their names, are read only as ``carry``.
    """
    small_batches(docs.sparkSession)
    tables = docs.sparkSession.sparkContext.broadcast(load(model_path))
    number = F.col(f"`{copy}`").cast("long") if copy else F.lit(0).cast("long")
    there, back = carried(carry)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(number, F.lit(0)).alias("_copy"), *there,
    )
    schema = rows.drop("text", "_copy").schema.add("token_ids", ArrayType(IntegerType())).add("lossless", "boolean")
    encoded = rows.mapInArrow(_encode(tables, dropout, seed), schema)
    return encoded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "lossless", *back)


def _decode(model) -> Callable:
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_ids([-1 if i is None else i for i in x or []], model.value) for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return decode


def decode(tokens: DataFrame, model_path: str = MODEL) -> DataFrame:
    """``doc_id, text`` from ``doc_id, token_ids``; null lists give an empty text, and
    ids that are null, not the model's or no UTF-8 give replacement characters."""
    tables = tokens.sparkSession.sparkContext.broadcast(load(model_path))
    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "token_ids").mapInArrow(
        _decode(tables), "doc_id long, text string"
    )
