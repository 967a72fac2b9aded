"""Substring dedup: paragraphs by MinHash banding, exact Jaccard, removals by components.

Paragraphs. A text is cut into sentences (line ends, and ``.``, ``!`` or ``?`` before
white space). Paragraphs of at least ``min_words`` words are (a) the lines, (b) the
maximal runs, in a line and in the whole text, of sentences that occur more than
once in the corpus (with or without one differing
sentence between any two, or with as many differing ones as the similarity allows for the run's words), and (c) the runs of sentences that occur equally often, so
that a passage pasted into the middle of a line, or into a text that is itself
copied, is a paragraph of its own. Sentence counts are taken over all documents; a sentence of fewer than
``sentence_words`` words is counted together with the short sentences after it (or, at the end of
such a row, before it) that make up that many words, and follows its neighbours where there are too few. A line none of whose sentences
is repeated cannot reach the similarity and is left out, unless it has so few
sentences that every one may hold an edit.

Passages that keep to no sentence or line border are found by content: a text is also cut
where the hash of the next ``CUT_WORDS`` words falls in one of ``CUT_MOD`` classes, whatever
marks stand there. These units are counted like sentences and give runs in the same
ways. The runs are then extended word by word to where the repeated text ends: next
to a unit that occurs more often, every window of ``EDGE_WORDS`` words is counted too. A
passage of 50 words without two cuts in it has a probability of 0.002.

Candidates. Equal paragraphs (by a 128-bit digest of their words) are one class from
the start. The distinct ones get a MinHash signature over word shingles, in
``bands`` bands of ``rows`` values; with 10 bands of 4 a pair at similarity 0.8 meets
with probability 0.995. Paragraphs that share a band are paired and verified by
the exact Jaccard similarity of their shingle sets, but for pairs that the counts of
their shingles in 64 bins (an upper bound of what they share) rule out before.

Components. Two paragraphs of one component need no comparison. So every bucket's
paragraphs are first verified against its leader (the most frequent one), and what is
left of a bucket is paired across components only.

Dense buckets. In a bucket of more than ``bucket_cap`` distinct paragraphs, those
outside the leader's component meet again by an exact way, the prefix filter: with all
shingles in one order, rare ones first, paragraphs at the similarity share one of the first few
of each, and those shingles from there on do for the similarity. This parts paragraphs that only share a hot
passage. They meet each other, and those of the leader's component where such a pair can
exist (the Jaccard distance is a metric), whatever the number. Nothing is dropped.

Removal. Linked paragraphs form components; of every component the first occurrence
(smallest id, then position) stays, with the paragraphs that overlap it there, and
the bytes of all others are removed.

Edge cases: null and empty texts have no paragraphs and stay as they are; null ids
come last in the order of occurrences; repeated rows are occurrences like any
other; an empty table gives an empty result; other columns are carried. ``docs``
must be a repeatable read (such as a table), since rows are numbered by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.components import connected_components
from tillcast.llm.memory import give_back, lean, settle
from tillcast.llm.packing import packed, unpack, unpacker
from tillcast.llm.store import carried, fresh, materialize, temporary_tables
from tillcast.llm.wordhash import ALNUM, FOLD, mix, range_hasher, text_slices, window_hashes, word_bounds

SHINGLE = 5
SIMILARITY = 0.8
MIN_WORDS = 50
SENTENCE_WORDS = 5
BANDS, ROWS = 10, 4
BUCKET_CAP = 64
COUNT_BINS, COUNT_RANGES = 1 << 20, 64  # classes of shingle hashes whose paragraphs are counted, and parts they are added up in
_BIN_SHIFT = np.uint64(44)
HELD_SHINGLES = 100_000  # shingles a comparing task keeps for the next pairs
CUT_WORDS, CUT_MOD, EDGE_WORDS = 4, 6, 5
GAP_WORDS = 40  # a gap between repeated units holds one edit at least, and one more for so many words
_EDITS_PER_WORD = 0.025  # an edited word breaks SHINGLE shingles: more edits than this cannot reach the similarity


def _end_marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of line ends, and of sentence ends (line ends included)."""
    line = data == 10
    stop = np.isin(data, (33, 46, 63))
    space = np.zeros(len(data), dtype=bool)
    if len(data):
        space[:-1] = np.isin(data[1:], (9, 10, 13, 32))
    return np.flatnonzero(line), np.flatnonzero(line | (stop & space))


class Slice:
    """Words and sentences of some texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low, self.starts, self.ends, self.first = word_bounds(data, offsets)
        self.words = range_hasher(low)(self.starts, self.ends)
        self.offsets = offsets
        lines, stops = _end_marks(data)
        self.stops, self.line_stop = stops, data[stops] == 10
        cuts = lambda at: np.unique(np.concatenate([self.first, np.searchsorted(self.starts, at)]))
        # word numbers where a line or a sentence begins; the last entry is the number of words
        self.lines = cuts(lines)
        self.sentences = cuts(stops)
        self.first_sentence = np.searchsorted(self.sentences, self.first)
        self.hash = range_hasher(self.words)

    def byte_ends(self, words: np.ndarray) -> np.ndarray:
        """Where the sentences that end before word number ``words`` end: after their mark, before
        a line end, and at the text's end for its last sentence."""
        close, last = self.ends[words - 1], np.searchsorted(self.first, words - 1, side="right") - 1
        at = np.minimum(np.searchsorted(self.stops, close), max(len(self.stops) - 1, 0))
        out = close.copy()
        if len(self.stops):
            mark = self.stops[at]
            follows = np.append(self.starts, 1 << 62)[words]
            out = np.where((mark >= close) & (mark < follows), mark + 1 - self.line_stop[at], close)
        return np.where(words == self.first[last + 1], self.offsets[last + 1], out)

    def sentence_keys(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first, past the last) of what every sentence is counted by: itself, or consecutive sentences
        of under ``least`` words that have as many together. Where there are too few, first = past the last."""
        a, b = self.sentences[:-1], self.sentences[1:]
        first = np.arange(len(a))
        last = first + 1
        short = b - a < least
        if short.any():
            parted = np.concatenate([[True], ~(short[:-1] & short[1:])])
            parted[self.first_sentence[self.first_sentence < len(a)]] = True
            begins = np.flatnonzero(parted)
            row = np.cumsum(parted) - 1
            low, high = begins[row], np.append(begins[1:], len(a))[row]
            ahead = np.searchsorted(self.sentences, a + least)
            behind = np.searchsorted(self.sentences, b - least, side="right") - 1
            forward, back = short & (ahead <= high), short & (ahead > high) & (behind >= low)
            last[forward] = ahead[forward]
            first[back] = behind[back]
            none = short & ~forward & ~back
            none[back] = forward[first[back]] & (last[first[back]] == last[back])  # the same words count once
            last[none] = first[none]
        return self.hash(self.sentences[first], self.sentences[last]), first, last

    def units(self) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of the cuts by content, number of cuts before each text). Two cuts of a text that
        follow one another are a unit, which holds the words that decide both of them."""
        windows = window_hashes(self.words, CUT_WORDS)
        cut = windows % np.uint64(CUT_MOD) == 0
        inner = np.ones(len(windows) + CUT_WORDS, dtype=bool)  # a text's first window has none before it
        inner[self.first] = False
        cut[1:] &= (windows[1:] != windows[:-1]) | ~inner[1:len(windows)]
        at = np.flatnonzero(cut)
        at = at[at + CUT_WORDS <= self.first[np.searchsorted(self.first, at, side="right")]]
        return at, np.searchsorted(at, self.first)

    def unit_keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, number in the text, hash) of every unit."""
        at, begins = self.units()
        text = np.searchsorted(begins, np.arange(len(at)), side="right") - 1
        whole = np.flatnonzero(text[:-1] == text[1:])
        keys = mix(self.hash(at[whole], at[whole + 1] + CUT_WORDS) + np.uint64(1))
        return text[whole], whole - begins[text[whole]], keys


def sentence_rows(docs: DataFrame, uid: str, text: str, least: int) -> DataFrame:
    """(uid, pos, key) of every sentence that can be counted (``Slice.sentence_keys``); pos counts all sentences
    of the text. Units of content have pos -1, -2 and so on."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, at = batch.column(0).to_numpy(), 0
            for data, offsets in text_slices(batch.column(1)):
                s = Slice(data, offsets)
                keys, low, high = s.sentence_keys(least)
                doc = np.repeat(np.arange(len(offsets) - 1), np.diff(s.first_sentence))
                pos = np.arange(len(keys)) - s.first_sentence[doc]
                keep = low < high
                yield pa.RecordBatch.from_arrays([pa.array(uids[at + doc[keep]]), pa.array(pos[keep].astype(np.int32)),
                                                  pa.array(keys[keep].view(np.int64))], ["uid", "pos", "key"])
                doc, number, keys = s.unit_keys()
                yield pa.RecordBatch.from_arrays([pa.array(uids[at + doc]), pa.array((-1 - number).astype(np.int32)),
                                                  pa.array(keys.view(np.int64))], ["uid", "pos", "key"])
                at += len(offsets) - 1
    return docs.select(uid, text).mapInArrow(lean(scan), "uid long, pos int, key long")


def _unit_counts(n: int, marks: pa.Scalar) -> np.ndarray:
    """Occurrences of each of a text's ``n`` units."""
    counts = np.ones(n, dtype=np.int64)
    if marks.is_valid:
        pos, times = marks.values.field("pos").to_numpy(), marks.values.field("n").to_numpy()
        counts[-1 - pos[pos < 0]] = times[pos < 0]
    return counts


def edge_rows(docs: DataFrame, marks: DataFrame, uid: str, text: str) -> DataFrame:
    """(uid, pos, key) of every window of ``EDGE_WORDS`` words that begins in a unit beside one that occurs more often."""
    cut = marks.filter(F.exists("repeated", lambda m: m["pos"] < 0))
    joined = docs.select(F.col(uid).alias("uid"), packed(F.col(text)).alias("packed")).join(cut, "uid")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, at = batch.column("uid").to_numpy(), 0
            for data, offsets in _slices(batch.column("packed")):
                s = Slice(data, offsets)
                cuts, begins = s.units()
                windows = window_hashes(s.words, EDGE_WORDS)
                here = batch.column("repeated").slice(at, len(offsets) - 1)
                doc, pos = [], []
                for k in range(len(offsets) - 1):
                    own = cuts[begins[k]:begins[k + 1]]
                    if len(own) < 2:
                        continue
                    # the words before the first cut and after the last one are units that occur once
                    counts = np.concatenate([[1], _unit_counts(len(own) - 1, here[k]), [1]])
                    edges = np.concatenate([[s.first[k]], own, [max(int(own[-1]), int(s.first[k + 1]) - EDGE_WORDS + 1)]])
                    beside = np.zeros(len(counts), dtype=bool)
                    beside[1:] |= counts[:-1] > counts[1:]
                    beside[:-1] |= counts[1:] > counts[:-1]
                    words = np.repeat(beside, np.diff(edges))
                    found = s.first[k] + np.flatnonzero(words)
                    found = found[found + EDGE_WORDS <= s.first[k + 1]]
                    pos.append(found)
                    doc.append(np.full(len(found), k))
                if pos:
                    doc_, found = np.concatenate(doc), np.concatenate(pos)
                    yield pa.RecordBatch.from_arrays([pa.array(uids[at + doc_]), pa.array((found - s.first[doc_]).astype(np.int32)),
                                                      pa.array(windows[found].view(np.int64))], ["uid", "pos", "key"])
                at += len(offsets) - 1
    return joined.mapInArrow(lean(scan), "uid long, pos int, key long")


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true entries, as (first, past the last)."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def _bridged(runs: list[tuple[int, int]], begins: np.ndarray, ends: np.ndarray, differing: np.ndarray) -> list[tuple[int, int]]:
    """Maximal joins of consecutive ``runs`` (words ``begins`` to ``ends`` each) with no more ``differing``
    (a running number per run) between them than edits are allowed for their words."""
    level = differing - _EDITS_PER_WORD * ends
    least = np.minimum.accumulate(level[::-1])[::-1]
    last = np.searchsorted(least, differing - _EDITS_PER_WORD * begins, side="right") - 1
    out, done = [], -1
    for i, j in enumerate(last.tolist()):
        if j > max(i, done):
            out.append((runs[i][0], runs[j][1]))
            done = j
    return out


def _content_ranges(cuts: np.ndarray, counts: np.ndarray, edge: np.ndarray, min_words: int) -> set[tuple[int, int]]:
    """Word ranges of one text's paragraphs by content. ``counts``: occurrences of the units between ``cuts``;
    ``edge``: occurrences of the window that begins at each word, where they were counted."""
    often = counts > 1
    runs = _runs(often)
    if not runs:
        return set()
    same = np.flatnonzero(np.diff(counts)) + 1
    equal = zip([0, *same.tolist()], [*same.tolist(), len(counts)])
    begins = cuts[[x for x, _ in runs]]
    ends = cuts[[y for _, y in runs]] + CUT_WORDS
    gaps = np.maximum(1.0, (begins[1:] - ends[:-1]) / GAP_WORDS)
    joined = _bridged(runs, begins, ends, np.concatenate([[0.0], np.cumsum(gaps)]))
    out: set[tuple[int, int]] = set()
    for x, y in {*runs, *joined, *((x, y) for x, y in equal if counts[x] > 1)}:
        i, j = int(cuts[x]), int(cuts[y]) + CUT_WORDS
        level = counts[x] if (counts[x:y] == counts[x]).all() else 2
        while i > 0 and edge[i - 1] >= level:
            i -= 1
        while j < len(edge) and edge[j - EDGE_WORDS + 1] >= level:
            j += 1
        if j - i >= min_words:
            out.add((i, j))
    return out


def _paragraphs(sizes: np.ndarray, counts: np.ndarray, low: np.ndarray, high: np.ndarray, line: np.ndarray, min_words: int) -> set[tuple[int, int]]:
    """Sentence ranges of one text's paragraphs. ``counts``: occurrences in the corpus of the sentences
    ``low`` to ``high`` that each one is counted by, 0 for sentences that cannot be counted; ``line``: the line of each sentence."""
    out: set[tuple[int, int]] = set()
    total = np.concatenate([[0], np.cumsum(sizes)])
    edges = np.concatenate([[0], np.flatnonzero(np.diff(line)) + 1, [len(line)]])
    long = np.flatnonzero(np.diff(total[edges]) >= min_words)
    lines = list(zip(edges[long].tolist(), edges[long + 1].tolist()))
    for a, b in lines:
        few = b - a <= _EDITS_PER_WORD * (total[b] - total[a]) + 1
        if few or counts[a:b].max(initial=0) > 1:
            out.add((a, b))
    if total[-1] < min_words or counts.max(initial=0) < 2:
        return out
    for a, b in {(0, len(line)), *lines}:
        known = a + np.flatnonzero(counts[a:b] > 0)
        level = counts[known]
        if level.max(initial=0) < 2:
            continue
        same = np.flatnonzero(np.diff(level)) + 1
        equal = zip([0, *same.tolist()], [*same.tolist(), len(level)])
        often = level > 1
        bridged = often.copy()  # one sentence that differs, as after an edit, between repeated ones
        bridged[1:-1] |= often[:-2] & often[2:]
        runs = _runs(often)
        begins, ends = total[[known[x] for x, _ in runs]], total[[known[y - 1] + 1 for _, y in runs]]
        joined = _bridged(runs, begins, ends, np.cumsum(~often)[[x for x, _ in runs]].astype(float))
        for x, y in {*runs, *_runs(bridged), *joined, *((x, y) for x, y in equal if level[x] > 1)}:
            i, j = max(a, int(low[known[x:y]].min())), min(b, int(high[known[x:y]].max()))
            if total[j] - total[i] >= min_words:
                out.add((i, j))
    return out


def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signature(shingles: np.ndarray, starts: np.ndarray, ends: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band keys [paragraph, band] of shingle ranges: each key mixes ``rows`` minima."""
    out = np.zeros((len(starts), bands), dtype=np.uint64)
    if len(starts):
        index = np.stack([starts, ends], axis=1).ravel()
        padded = np.append(shingles, np.uint64(0xFFFFFFFFFFFFFFFF))
        draw = _multipliers(2 * bands * rows)
        work = np.empty_like(padded)
        for k, (m, x) in enumerate(zip(draw[::2], draw[1::2])):  # shingles are hashes: a shift and a product order them anew
            np.bitwise_xor(padded, x, out=work)
            work *= m
            low = np.minimum.reduceat(work, index)[::2]
            out[:, k // rows] = mix(out[:, k // rows] * np.uint64(31) + low)
    return out


PARAGRAPHS = T.StructType([
    T.StructField("uid", T.LongType()), T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("digest", T.LongType()), T.StructField("check", T.LongType()),
    T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("packed", T.BinaryType())])


def paragraph_rows(docs: DataFrame, marks: DataFrame, edges: DataFrame, uid: str, text: str, min_words: int, shingle: int, bands: int, rows: int) -> DataFrame:
    """One row per paragraph (``PARAGRAPHS``); ``marks``: (uid, repeated: array of (pos, n)) of texts with
    repeated sentences or units; ``edges``: (uid, edge: array of (pos, n)) of texts with repeated windows."""
    joined = docs.select(F.col(uid).alias("uid"), packed(F.col(text)).alias("packed")).join(marks, "uid", "left").join(edges, "uid", "left")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, at = batch.column("uid").to_numpy(), 0
            for data, offsets in _slices(batch.column("packed")):
                s = Slice(data, offsets)
                _, low, high = s.sentence_keys(SENTENCE_WORDS)
                sizes = np.diff(s.sentences)
                line_of = np.searchsorted(s.lines, s.sentences[:-1], side="right")
                found = []
                here, edge_here = (batch.column(c).slice(at, len(offsets) - 1) for c in ("repeated", "edge"))
                cuts, begins = s.units()
                lengths = np.diff(s.first_sentence)
                for k in range(len(offsets) - 1):
                    if not lengths[k]:
                        continue
                    a, b = s.first_sentence[k], s.first_sentence[k + 1]
                    counts = (low[a:b] < high[a:b]).astype(np.int64)
                    if here[k].is_valid:
                        part = here[k].values
                        pos, times = part.field("pos").to_numpy(), part.field("n").to_numpy()
                        counts[pos[pos >= 0]] = times[pos >= 0]
                    own = [(int(s.sentences[a + i]), int(s.sentences[a + j])) for i, j in
                           _paragraphs(sizes[a:b], counts, low[a:b] - a, high[a:b] - a, line_of[a:b], min_words)]
                    w = int(s.first[k])
                    at_cuts = cuts[begins[k]:begins[k + 1]] - w
                    if here[k].is_valid and len(at_cuts) > 1:
                        edge = np.zeros(s.first[k + 1] - w, dtype=np.int64)
                        if edge_here[k].is_valid:
                            part = edge_here[k].values
                            edge[part.field("pos").to_numpy()] = part.field("n").to_numpy()
                        more = {(w + i, w + j) for i, j in _content_ranges(at_cuts, _unit_counts(len(at_cuts) - 1, here[k]), edge, min_words)}
                        # one that fills a paragraph of whole sentences but for a few words is that paragraph
                        own += [(i, j) for i, j in more if not any(x <= i and j <= y and 20 * (j - i) >= 19 * (y - x) for x, y in own)]
                    found += [(k, i, j) for i, j in own]
                if found:
                    found.sort()
                    doc, w0, w1 = np.array(found).T
                    sig = signature(window_hashes(s.words, shingle), w0, w1 - shingle + 1, bands, rows)
                    check = range_hasher(mix(s.words + np.uint64(1)))(w0, w1)
                    raw, press = data.tobytes(), zstandard.ZstdCompressor(level=3).compress
                    texts = [press(raw[x:y]) for x, y in zip(s.starts[w0].tolist(), s.ends[w1 - 1].tolist())]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(uids[at + doc]), pa.array((s.starts[w0] - offsets[doc]).astype(np.int32)),
                        pa.array((s.byte_ends(w1) - offsets[doc]).astype(np.int32)),
                        pa.array(s.hash(w0, w1).view(np.int64)), pa.array(check.view(np.int64)),
                        pa.array(list(sig.view(np.int64)), pa.list_(pa.int64())), pa.array(texts, pa.binary())], PARAGRAPHS.names)
                at += len(offsets) - 1
    return joined.mapInArrow(lean(scan), PARAGRAPHS)


def _slices(packed_: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``text_slices`` of compressed texts, some hundred decompressed at a time."""
    expand = unpacker()
    for a in range(0, len(packed_), 256):
        yield from text_slices(pa.array([expand(p) for p in packed_.slice(a, 256).to_pylist()], pa.large_binary()))


_WORD_BYTES = np.where(ALNUM[FOLD], FOLD, 32).astype(np.uint8).tobytes()  # case folded, spaces between words


def _shingle_set(text: bytes, shingle: int) -> frozenset[bytes]:
    """The word shingles of a paragraph, as they are written (case folded), each with a space after every word."""
    words = text.translate(_WORD_BYTES).split()
    row = b" ".join([*words, b""])
    edges = list(accumulate([len(w) + 1 for w in words], initial=0))
    return frozenset([row[a:b] for a, b in zip(edges, edges[shingle:])])


OVERLAP = T.StructType([T.StructField("shared", T.LongType()), T.StructField("total", T.LongType())])


def overlaps(a: pa.Array, b: pa.Array, shingle: int) -> pa.StructArray:
    """(shared shingles, all shingles) of pairs of compressed paragraphs, some hundred pairs at a time."""
    known: dict[bytes, frozenset[bytes]] = {}
    held = 0  # shingles in ``known``
    expand = unpacker()

    def sets(p: bytes) -> frozenset[bytes]:
        nonlocal held
        if p not in known:
            if held > HELD_SHINGLES:
                known.clear()
                held = 0
            known[p] = _shingle_set(expand(p), shingle)
            held += len(known[p])
        return known[p]

    shared, total = [], []
    for at in range(0, len(a), 256):
        for p, q in zip(a.slice(at, 256).to_pylist(), b.slice(at, 256).to_pylist()):
            x, y = sets(p), sets(q)
            shared.append(len(x & y))
            total.append(len(x) + len(y) - shared[-1])
    return pa.StructArray.from_arrays([pa.array(shared, pa.int64()), pa.array(total, pa.int64())], names=["shared", "total"])


def similarity_column(a: Column, b: Column, shingle: int) -> Column:
    """(shared shingles, all shingles) of two compressed paragraphs; their quotient is the Jaccard similarity."""
    @F.arrow_udf(OVERLAP)
    def overlap(a_: pa.Array, b_: pa.Array) -> pa.Array:
        settle()
        out = overlaps(a_, b_, shingle)
        give_back()
        return out
    return overlap(a, b)


def _distinct(column: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each compressed paragraph, ascending."""
    for data, offsets in _slices(column):
        low, starts, ends, first = word_bounds(data, offsets)
        windows = window_hashes(range_hasher(low)(starts, ends), shingle)
        for a, b in zip(first[:-1].tolist(), (first[1:] - shingle + 1).tolist()):
            yield np.unique(windows[a:max(a, b)])


def shingle_counts(texts: DataFrame, shingle: int) -> np.ndarray:
    """How many paragraphs (column packed) hold a shingle of each of ``COUNT_BINS`` classes of hashes, shingles
    counted one by one. The size is fixed; what a task finds is added up range by range."""
    per = COUNT_BINS // COUNT_RANGES

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNT_BINS, dtype=np.int64)
        for batch in batches:
            for own in _distinct(batch.column(0), shingle):
                np.add.at(total, (own >> _BIN_SHIFT).astype(np.int64), 1)
        press = zstandard.ZstdCompressor(level=1).compress
        filled = [r for r in range(COUNT_RANGES) if total[r * per:(r + 1) * per].any()]
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array([press(total[r * per:(r + 1) * per].tobytes()) for r in filled], pa.binary())],
                                         ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(per, dtype=np.int64), None
        for batch in batches:
            for part, c in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                total += np.frombuffer(unpack(c), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.minimum(total, 1 << 31).astype(np.uint32).tobytes()], pa.binary())], ["part", "counts"])

    found = texts.select("packed").mapInArrow(lean(scan), "part int, counts binary").groupBy("part").applyInArrow(add, "part int, counts binary")
    out = np.zeros(COUNT_BINS, dtype=np.uint32)
    for r in found.collect():
        out[r["part"] * per:(r["part"] + 1) * per] = np.frombuffer(r["counts"], dtype=np.uint32)
    return out


PREFIX = T.ArrayType(T.StructType([T.StructField("key", T.LongType()), T.StructField("pos", T.IntegerType()), T.StructField("size", T.IntegerType())]))


def prefixes(packed_: Column, counts, shingle: int, least: float) -> Column:
    """The shingles of compressed paragraphs by which those of the Jaccard similarity ``least`` meet: with all shingles in
    one order (here rare ones first, by the broadcast ``counts``), two of them share one of the first few of each.
    Shingles of no other paragraph are left out. ``pos``: place in the order, ``size``: distinct shingles."""
    @F.arrow_udf(PREFIX)
    def keys(column: pa.Array) -> pa.Array:
        settle()
        offsets, key, pos, size = [0], [], [], []
        for own in _distinct(column, shingle):
            times = counts.value[(own >> _BIN_SHIFT).astype(np.int64)]
            first = np.argsort(times, kind="stable")[:int((1 - least) * len(own) + 1e-6) + 1]
            at = np.flatnonzero(times[first] > 1)
            key.append(own[first[at]].view(np.int64))
            pos.append(at.astype(np.int32))
            size.append(np.full(len(at), len(own), dtype=np.int32))
            offsets.append(offsets[-1] + len(at))
        flat = [pa.array(np.concatenate(x) if x else np.zeros(0, t), pa.from_numpy_dtype(t)) for x, t in ((key, np.int64), (pos, np.int32), (size, np.int32))]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(flat, names=["key", "pos", "size"]))
    return keys(packed_)


SKETCH = np.dtype([("distinct", "<u4"), ("bins", "u1", 64)])


def sketches(packed_: Column, shingle: int) -> Column:
    """``SKETCH`` of compressed paragraphs: how many distinct shingles they have at least, and how many shingles,
    repeats included, fall in each of 64 bins (255: so many or more)."""
    @F.arrow_udf(T.BinaryType())
    def sketch(column: pa.Array) -> pa.Array:
        settle()
        out = []
        for data, offsets in _slices(column):
            low, starts, ends, first = word_bounds(data, offsets)
            windows = window_hashes(range_hasher(low)(starts, ends), shingle)
            n = len(offsets) - 1
            size = np.maximum(np.diff(first) - shingle + 1, 0)
            text = np.repeat(np.arange(n), size)
            own = windows[np.arange(len(text)) + np.repeat(first[:-1] - np.cumsum(size) + size, size)]
            rows = np.zeros(n, dtype=SKETCH)
            bins = np.bincount(text * 64 + (own >> np.uint64(58)).astype(np.int64), minlength=64 * n)
            rows["bins"] = np.minimum(bins, 255).reshape(n, 64)
            seen = np.sort(text.astype(np.uint64) << np.uint64(40) | own >> np.uint64(24))  # equal ones count once: not too many
            rows["distinct"] = np.bincount((seen[np.append(True, seen[1:] != seen[:-1])[:len(seen)]] >> np.uint64(40)).astype(np.int64), minlength=n)
            out += [r.tobytes() for r in rows]
        give_back()
        return pa.array(out, pa.binary())
    return sketch(packed_)


def may_reach(a: pa.Array, b: pa.Array, least: float) -> np.ndarray:
    """Whether paragraphs of these sketches can have the Jaccard similarity ``least``: they share no more
    shingles than fall in the same bins. False is certain, true is not."""
    x, y = (np.frombuffer(b"".join(c.to_pylist()), dtype=SKETCH) for c in (a, b))
    shared = np.minimum(x["bins"], y["bins"]).sum(axis=1, dtype=np.int64)
    total = x["distinct"].astype(np.int64) + y["distinct"] - shared
    full = ((x["bins"] == 255) & (y["bins"] == 255)).any(axis=1)
    return full | (shared >= least * total)


def _possible(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """``pairs`` without those whose sketches rule out the similarity ``least``."""
    @F.arrow_udf(T.BooleanType())
    def possible(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(may_reach(a, b, least))
    return (pairs.join(texts.select(F.col("digest").alias("a"), F.col("sketch").alias("_sa")), "a")
            .join(texts.select(F.col("digest").alias("b"), F.col("sketch").alias("_sb")), "b")
            .filter(possible("_sa", "_sb")).select(*pairs.columns))


def _named(met: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (rows of ``met``) of the buckets that hold paragraphs of more than one component, with their ``root``."""
    named = met.join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    mixed = named.groupBy("band", "key").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).filter("_low < _high")
    return named.join(mixed.select("band", "key"), ["band", "key"], "left_semi")


def _bucket_pairs(named: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b), a < b, of digests of different components that share a bucket (columns digest, band, key, role, root,
    pos, size). Those of role 2 meet those of role 1 only. In a bucket of prefixes the key is the first that similar
    paragraphs share, so the shingles from there on must do for the similarity."""
    left, right = (named.select("band", "key", F.col("digest").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("role", "root", "pos", "size")]) for x in "ab")
    rest = F.least(F.col("size_a") - F.col("pos_a"), F.col("size_b") - F.col("pos_b"))
    return (left.join(right, ["band", "key"]).filter("a < b AND root_a != root_b AND (role_a < 2 AND role_b < 2 OR role_a + role_b = 3)")
            .filter(rest * F.lit(1 + least) + F.lit(1e-6) >= F.lit(least) * (F.col("size_a") + F.col("size_b"))).select("a", "b").distinct())


def _verified(pairs: DataFrame, texts: DataFrame, least: float, shingle: int) -> DataFrame:
    """``pairs`` with ``similar``, and ``near``: whether something similar to ``a`` can be similar to ``b``."""
    out = (pairs.join(texts.select(F.col("digest").alias("a"), F.col("packed").alias("_pa")), "a")
           .join(texts.select(F.col("digest").alias("b"), F.col("packed").alias("_pb")), "b"))
    out = out.withColumn("_o", similarity_column(F.col("_pa"), F.col("_pb"), shingle))
    at_least = lambda x: F.col("_o.shared") >= F.lit(x) * F.col("_o.total")
    return out.select(*pairs.columns, at_least(least).alias("similar"), at_least(2 * least - 1 - 1e-9).alias("near"))


def _next_roles(open_: DataFrame, tried: DataFrame, roots: DataFrame) -> DataFrame:
    """(digest, n, role) of the paragraphs that must meet again after ``tried`` (a: leader, b, similar, near).

    Those of the leader's component need not meet each other. Role 0: in no leader's component so far, and far from what
    agreed with a leader; role 1: like that, but something in a leader's component may resemble it (the leader is near, or
    the component holds members of the bucket that do not resemble the leader themselves); role 2: what role 1 may
    resemble there, and only compared with role 1."""
    root = lambda x: roots.select(F.col("digest").alias(x), F.col("root").alias(f"c{x}"))
    judged = (tried.join(root("a"), "a", "left").join(root("b"), "b", "left")
              .withColumn("one", F.coalesce("ca", "a") == F.coalesce("cb", "b")))
    heads = judged.groupBy("a").agg(F.max(~F.col("one")).alias("apart"), F.max(~F.col("one") & F.col("near")).alias("beside"),
                                    F.max(F.col("one") & ~F.col("similar")).alias("chained")).filter("apart")
    judged = judged.join(heads, "a").join(open_.select(F.col("digest").alias("b"), F.col("role").alias("old")), "b")
    parted = judged.filter("NOT one AND (old < 2 OR near OR chained)").groupBy(F.col("b").alias("digest")).agg(
        F.max(F.when(F.col("near") | F.col("chained") | (F.col("old") == 1), 1).otherwise(0)).alias("role"))
    met = judged.filter("one AND (NOT similar OR beside)").select(F.col("b").alias("digest")).unionByName(
        open_.filter("role = 2").select("digest")).distinct().join(parted, "digest", "left_anti")
    roles = parted.unionByName(met.withColumn("role", F.lit(2)))
    return roles.join(open_.select("digest", "n"), "digest").select("digest", "n", "role")


def links(found: DataFrame, similarity: float = SIMILARITY, bucket_cap: int = BUCKET_CAP, shingle: int = SHINGLE,
          bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Verified links (a, b) between distinct paragraphs of ``found`` (digest, bands, packed), enough to join each component."""
    spark = found.sparkSession
    open_ = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands")).withColumn("role", F.lit(0))
    banded = open_.select("digest", "n", "role", F.posexplode("bands").alias("band", "key"), F.lit(0).alias("pos"), F.lit(0).alias("size"))
    texts, out = None, []
    for level in (1, 2):
        load = (banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members"), F.max(F.when(F.col("role") < 2, F.struct("role", "n", "digest"))).alias("top"))
                .filter("members > 1 AND top IS NOT NULL").select("band", "key", "members", F.col("top.digest").alias("leader"), F.col("top.role").alias("leads")))
        met = materialize(banded.join(load, ["band", "key"]), f"substring-buckets-{level}")
        if texts is None:  # only paragraphs that share a bucket are ever compared
            texts = found.select("digest", "packed").join(met.select("digest").distinct(), "digest", "left_semi")
            texts = texts.groupBy("digest").agg(F.first("packed").alias("packed"))
            texts = materialize(texts.withColumn("sketch", sketches(F.col("packed"), shingle)), "substring-compared")
        star = met.filter((F.col("digest") != F.col("leader")) & ((F.col("role") < 2) | (F.col("leads") == 1)))
        star = star.groupBy(F.col("leader").alias("a"), F.col("digest").alias("b")).agg(F.max(F.col("members") > bucket_cap).alias("dense"))
        # written step by step, so that only one step's texts are in shuffle files at a time
        tried = materialize(_verified(_possible(star, texts, 2 * similarity - 1 - 1e-9), texts, similarity, shingle), f"substring-leaders-{level}")
        out.append(tried.filter("similar").select("a", "b"))
        roots = materialize(connected_components(spark, reduce(DataFrame.unionByName, out)).withColumnRenamed("node", "digest"), f"substring-roots-{level}")
        named = materialize(_named(met, roots), f"substring-mixed-{level}")
        sparse = named if level == 2 else named.filter(F.col("members") <= bucket_cap)
        pairs = _possible(_bucket_pairs(sparse, similarity), texts, similarity)
        out.append(materialize(_verified(pairs, texts, similarity, shingle).filter("similar").select("a", "b"), f"substring-links-{level}"))
        if level == 2:
            break
        tried = star.filter("dense").select("a", "b").join(tried.select("a", "b", "similar", "near"), ["a", "b"], "left").na.fill(False)
        open_ = materialize(_next_roles(open_.select("digest", "n", "role"), tried, roots), f"substring-roles-{level}")
        if open_.filter("role < 2").isEmpty():
            break
        again = materialize(texts.join(open_, "digest").select("digest", "n", "role", "packed"), "substring-again")
        counts = spark.sparkContext.broadcast(shingle_counts(again, shingle))
        met_by = F.explode(prefixes(F.col("packed"), counts, shingle, similarity)).alias("by")
        banded = materialize(again.select("digest", "n", "role", met_by).select("digest", "n", "role", F.lit(0).alias("band"), "by.key", "by.pos", "by.size"), "substring-prefixes")
    return reduce(DataFrame.unionByName, out)


def repeated_spans(docs: DataFrame, uid: str, text_col: str, id_col: str, similarity: float = SIMILARITY, min_words: int = MIN_WORDS,
                   shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """(uid, spans, kept_in): byte ranges to remove and the ids of the documents that keep
    the removed paragraphs, for every text that loses any."""
    spark = docs.sparkSession
    sentences = sentence_rows(docs, uid, f"`{text_col}`", SENTENCE_WORDS).repartition("key")  # one scan and shuffle for both uses
    often = sentences.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    marks = (sentences.join(often, "key").groupBy("uid")
             .agg(F.collect_list(F.struct("pos", "n")).alias("repeated")))  # at most the sentences of one text
    with temporary_tables(spark):
        marks = materialize(marks, "substring-marks")
        windows = materialize(edge_rows(docs, marks, uid, f"`{text_col}`"), "substring-edges")
        shared = windows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        edges = (windows.join(shared, "key").groupBy("uid")
                 .agg(F.collect_list(F.struct("pos", "n")).alias("edge")))  # at most the words of one text
        found = paragraph_rows(docs, marks, edges, uid, f"`{text_col}`", min_words, shingle, bands, rows)
        found = materialize(found, "substring-paragraphs", keep=True)
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("uid"), F.col("begin"), (-F.col("end")).alias("size"))
    named = found.select("uid", "begin", "end", "digest", "check").join(
        docs.select(F.col(uid).alias("uid"), F.col(f"`{id_col}`").alias("id")), "uid")
    classes = materialize(named.groupBy("digest", "check").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")), "substring-classes")
    roots = connected_components(spark, links(found, similarity, bucket_cap, shingle, bands, rows))
    labelled = classes.join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    heads = labelled.groupBy("root").agg(F.min("first").alias("head"), F.sum("n").alias("total")).filter("total > 1")
    plan = labelled.join(heads, "root").select("digest", "check", "head")
    gone = (found.select("uid", "begin", "end", "digest", "check").join(plan, ["digest", "check"])
            .filter((F.col("uid") != F.col("head.uid")) | (F.col("begin") >= -F.col("head.size")) | (F.col("end") <= F.col("head.begin"))))
    return gone.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"),
                                   F.array_sort(F.collect_set("head.id")).alias("kept_in"))


CUT = T.StructType([T.StructField("text", T.StringType()), T.StructField("removed", T.LongType()), T.StructField("runs", T.LongType())])


def cut_column(packed_: Column, spans: Column) -> Column:
    """The text of compressed bytes without its spans, the bytes removed and the number of maximal removed runs."""
    @F.arrow_udf(CUT)
    def cut(column: pa.Array, spans_: pa.Array) -> pa.Array:
        texts, removed, runs = [], [], []
        for p, s in zip(column.to_pylist(), spans_.to_pylist()):
            gone = n = 0
            t = None if p is None else unpack(p)
            if t is not None and s:
                raw, kept, at = t, [], 0
                for x in s:
                    if x["end"] <= at:
                        continue
                    if x["begin"] > at or not n:
                        kept.append(raw[at:x["begin"]])
                        n += 1
                    gone += x["end"] - max(at, x["begin"])
                    at = x["end"]
                t = b"".join([*kept, raw[at:]])
            texts.append(None if t is None else t.decode("utf-8"))
            removed.append(gone)
            runs.append(n)
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64())],
                                          names=["text", "removed", "runs"])
    return cut(packed_, spans)


def remove_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", out: str = "repeats", **options) -> DataFrame:
    """``docs`` with repeated paragraphs cut out of the text, plus a struct ``out`` (a column
    of that name is replaced): removed bytes, runs, and kept_in (ids of the documents
    that keep the removed paragraphs)."""
    uid = fresh("_substring", docs.columns)
    numbered = docs.withColumn(uid, F.monotonically_increasing_id())
    with temporary_tables(docs.sparkSession):
        spans = repeated_spans(numbered, uid, text_col, id_col, **options)
        spans = materialize(spans.withColumnRenamed("uid", f"{uid}r").withColumnRenamed("spans", f"{uid}s").withColumnRenamed("kept_in", f"{uid}k"), "substring-spans", keep=True)
    texts = numbered.select(*carried(docs.columns, out, text_col), uid, packed(F.col(f"`{text_col}`")).alias(f"{uid}p"))
    joined = texts.join(spans, F.col(uid) == F.col(f"{uid}r"), "left")
    done = joined.withColumn(f"{uid}c", cut_column(F.col(f"{uid}p"), F.col(f"{uid}s")))
    own = [F.col(f"{uid}c.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()]
    return done.select(*own, F.struct(F.col(f"{uid}c.removed").alias("removed"), F.col(f"{uid}c.runs").alias("runs"),
                                      F.coalesce(F.col(f"{uid}k"), F.array().cast(spans.schema[f"{uid}k"].dataType)).alias("kept_in")).alias(out))
