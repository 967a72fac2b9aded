"""BPE encoding and decoding with a public tokenizer file, exact to its library.

White space is a hard boundary of the tokenizer (its pre-tokenizer drops it and
no merge or normalisation crosses it), so a text is encoded word by word, and
a task keeps the ids of the words it has met in a bounded table.

Tree concatenation. A long run without white space cannot be cut that way.
Its normalised pre-tokens come from the library in one linear pass; a pre-token
longer than ``unsplit`` is halved until the parts are short, the parts are
encoded in parallel, and the halves are joined bottom up. At a join, a window of
the last tokens of the left half and the first tokens of the right one is
encoded again and grows until its first token is the left half's and its last
token is the right half's. Then every adjacent pair of tokens of the joined
sequence is one that the merges produce, which for merges applied in rank order
makes the whole sequence the encoding: a merge across a token border would also
have happened in the encoding of that pair alone.

Edge cases: null and empty texts give no ids and decode to the empty string;
special tokens written in a text become their ids, as in the library; lone
surrogates cannot occur in Spark strings; ids outside the vocabulary are left
out on decoding; very long texts are coded whole; repeated rows and other columns are carried as they are;
an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.memory import give_back, lean
from tillcast.llm.store import carried

UNSPLIT = 512           # characters of a pre-token that are encoded in one piece
ROWS_OUT = 256          # rows of an outgoing batch
CACHE_WORDS = 200_000   # words whose ids a task keeps; the table starts anew beyond it
CACHED_LENGTH = 48      # longer words are rarely met again
CHUNK = 1 << 20         # characters of text per round of the word table
_CODERS: dict[tuple[str, int], Coder] = {}
# Latin-1 letters: each is one composed letter, lower-cased alone, and spelled alone by the pre-tokenizer
_LATIN = [chr(i) for i in range(256) if chr(i).isalpha() and chr(i) not in "\xaa\xb5\xba"]
_PLAIN = re.compile("([" + "".join(_LATIN) + "]+)([.,;:!?]*)")


class Coder:
    """One tokenizer file, loaded once per Python worker."""

    def __init__(self, path: str, unsplit: int = UNSPLIT):
        from tokenizers import Tokenizer

        self.path = path
        spec = self._spec()
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.last = self._bare(spec)
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("|".join(re.escape(c) for c in self.special)) if self.special else None
        # how the pre-tokenizer spells each Latin-1 letter, in lower case, for words that need no more than that
        spell = [p[0] for p in map(self.whole.pre_tokenizer.pre_tokenize_str, map(str.lower, _LATIN))]
        self.spell = {ord(c): p[0] for c, p in zip(_LATIN, spell)}
        self.unsplit = unsplit
        self.ids: dict[str, bytes] = {"": b""}
        size = max([*spec["model"]["vocab"].values(), *self.special.values()]) + 1
        names: list[str | None] = [None] * size
        for token, i in [*spec["model"]["vocab"].items(), *self.special.items()]:
            names[i] = token + " "
        self.names = pa.array([n or "" for n in names], pa.large_string())
        self.width = [len(n[:-1].removesuffix(self.suffix) if self.suffix else n[:-1]) if n else 0 for n in names]

    def _spec(self) -> dict:
        with open(self.path, encoding="utf-8") as f:
            return json.load(f)

    @staticmethod
    def _bare(spec: dict):
        """The model alone."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "decoder": None,
                                                     "added_tokens": [], "truncation": None, "padding": None}))

    # -- encoding ---------------------------------------------------------

    @cached_property
    def inner(self):
        """Tokenizer of the parts before the last one of a pre-token, which carry no end-of-word mark."""
        spec = self._spec()
        return self._bare(spec | {"model": spec["model"] | {"end_of_word_suffix": None}})

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of whitespace-free words, as little-endian unsigned 32-bit integers."""
        out = [b""] * len(words)
        rest = []
        pieces, whose = [], []
        for k, w in enumerate(words):
            if len(w) <= self.unsplit:
                if m := _PLAIN.fullmatch(w):  # letters, then sentence marks: two pre-tokens, known without the library
                    for piece in m.groups():
                        if piece:
                            pieces.append(piece.translate(self.spell))
                            whose.append(k)
                else:
                    rest.append(k)
        for model, texts, owners in ((self.last, pieces, whose), (self.whole, [words[k] for k in rest], rest)):
            for a in range(0, len(texts), 4096):
                got = model.encode(texts[a:a + 4096], is_pretokenized=True, add_special_tokens=False)
                ids = np.array(got.ids, dtype="<u4")
                cuts = np.searchsorted(np.array(got.word_ids, dtype=np.int64), np.arange(len(texts[a:a + 4096]) + 1))
                for k, x, y in zip(owners[a:a + 4096], cuts[:-1].tolist(), cuts[1:].tolist()):
                    out[k] += ids[x:y].tobytes()
        for k, w in enumerate(words):
            if len(w) > self.unsplit:
                out[k] = np.array(self.encode_run(w), dtype="<u4").tobytes()
        return out

    def encode_run(self, run: str) -> list[int]:
        """Ids of one long whitespace-free run, by tree concatenation."""
        ids: list[int] = []
        at = 0
        for m in [*(self.cut.finditer(run) if self.cut else ()), None]:
            plain = run[at:m.start() if m else len(run)]
            for piece, _ in self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(plain)):
                ids += self.encode_piece(piece)
            if m:
                ids.append(self.special[m[0]])
                at = m.end()
        return ids

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one pre-token (byte-level characters) of any length."""
        if len(piece) <= self.unsplit:
            return self.last.encode(piece, add_special_tokens=False).ids
        cuts = list(range(0, len(piece), self.unsplit))
        parts = [(a, min(a + self.unsplit, len(piece))) for a in cuts]
        inner = self.inner.encode_batch([piece[a:b] for a, b in parts[:-1]], add_special_tokens=False)  # in parallel
        a, b = parts[-1]
        level = [(x, y, e.ids) for (x, y), e in zip(parts[:-1], inner)]
        level.append((a, b, self.last.encode(piece[a:b], add_special_tokens=False).ids))
        while len(level) > 1:
            joined = [self._join(piece, level[k], level[k + 1]) for k in range(0, len(level) - 1, 2)]
            level = joined + level[len(joined) * 2:]
        return level[0][2]

    def _join(self, piece: str, left: tuple, right: tuple) -> tuple:
        start, middle, l_ids = left
        _, stop, r_ids = right
        grow = 1
        while True:
            i, j = min(grow, len(l_ids)), min(grow, len(r_ids))
            a = middle - sum(self.width[t] for t in l_ids[len(l_ids) - i:])
            b = middle + sum(self.width[t] for t in r_ids[:j])
            model = self.last if b == len(piece) else self.inner
            window = model.encode(piece[a:b], add_special_tokens=False).ids
            agree_left = a == start or window[0] == l_ids[len(l_ids) - i]
            agree_right = b == stop or window[-1] == r_ids[j - 1]
            if agree_left and agree_right:
                return start, stop, l_ids[:len(l_ids) - i] + window + r_ids[j:]
            grow *= 2

    def encode_texts(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        for group in _groups(texts):
            split = [t.replace("\n", " ").replace("\t", " ").split(" ") if t else [] for t in group]
            known = self.ids
            missing = list({w for words in split for w in words if w not in known})
            if len(known) + len(missing) > CACHE_WORDS:
                known = self.ids = {"": b""}
                missing = list({w for words in split for w in words if w})
            fresh = dict(zip(missing, self.encode_words(missing)))
            known.update(fresh)
            out += [b"".join([known[w] for w in words]) for words in split]
            for w in fresh:
                if len(w) > CACHED_LENGTH:
                    del known[w]
        return out

    # -- decoding ---------------------------------------------------------

    def decode_lists(self, ids: pa.Array) -> pa.Array:
        """Decoded strings of a list array: the tokens' strings joined by spaces,
        special tokens included (the file names no decoder)."""
        if isinstance(ids, pa.ListArray):
            ids = ids.cast(pa.large_list(pa.int32()))
        flat = ids.flatten()  # without the entries under nulls
        lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        first = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(lengths, out=first[1:])
        valid = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(self.names)))
        tokens = self.names.take(pc.if_else(valid, flat, pa.scalar(None, pa.int32()))).fill_null("")
        _, off, data = tokens.buffers()
        off = np.frombuffer(off, dtype=np.int64)[tokens.offset:tokens.offset + len(tokens) + 1]
        joined = pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(np.ascontiguousarray(off[first])), data)
        return pc.utf8_slice_codeunits(joined, 0, -1)


def _groups(texts: list[str | None]) -> Iterator[list[str | None]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def coder(path: str, unsplit: int = UNSPLIT) -> Coder:
    if (path, unsplit) not in _CODERS:
        _CODERS[path, unsplit] = Coder(path, unsplit)
        give_back()  # what reading the file took
    return _CODERS[path, unsplit]


def _lists(parts: list[bytes]) -> pa.ListArray:
    """Packed ids as a list array."""
    ends = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) // 4 for p in parts], out=ends[1:])
    flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)


def encode(text: Column, path: str, unsplit: int = UNSPLIT) -> Column:
    """Token ids of each text (array of int; empty for null)."""
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def bpe_encode(column: pa.Array) -> pa.Array:
        return _lists(coder(path, unsplit).encode_texts(column.to_pylist()))
    return bpe_encode(text)


def decode(ids: Column, path: str) -> Column:
    """The string that the library's ``decode(ids, skip_special_tokens=False)`` gives."""
    @F.arrow_udf(T.StringType())
    def bpe_decode(column: pa.Array) -> pa.Array:
        return coder(path).decode_lists(column).cast(pa.string())
    return bpe_decode(ids)


def encode_and_decode(df: DataFrame, path: str, text_col: str = "text", out: str = "coded", unsplit: int = UNSPLIT) -> DataFrame:
    """``df`` plus a struct ``out`` (a column of that name is replaced): ids, packed as
    little-endian unsigned 32-bit integers, and decoded, the text made from them.

    One pass over the rows: the ids are made once, a task needs one Python
    worker, and rows leave in small batches however large the incoming ones are."""
    own = df.select(*carried(df.columns, out))
    at, plain = own.columns.index(text_col), [f"c{i}" for i in range(len(own.columns) + 1)]  # names without dots inside
    coded = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    types = [f.dataType for f in own.schema.fields] + [coded]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), ROWS_OUT):
                part = batch.slice(a, ROWS_OUT)
                ids = coder(path, unsplit).encode_texts(part.column(at).to_pylist())
                both = pa.StructArray.from_arrays([pa.array(ids, pa.binary()), coder(path, unsplit).decode_lists(_lists(ids)).cast(pa.string())],
                                                  names=["ids", "decoded"])
                yield pa.RecordBatch.from_arrays([*part.columns, both], names=plain)

    schema = T.StructType([T.StructField(n, t) for n, t in zip(plain, types)])
    return own.toDF(*plain[:-1]).mapInArrow(lean(code), schema).toDF(*own.columns, out)
