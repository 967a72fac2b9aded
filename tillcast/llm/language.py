"""Language identification by unigram pieces, summed over all segmentations.

The pieces are a fixed public vocabulary. Every language has a probability for
each piece; a word's probability under a language is the sum over all its
segmentations into pieces (forward algorithm), and a text's is the product
over its words. The probabilities are trained per language with
expectation-maximisation: forward and backward sums give the expected number
of uses of each piece over all segmentations of the training words.

Training reads at most ``max_rows`` labelled texts, shared equally by the
languages (those of the least hash of id and text), and only distinct words with their counts reach the per-language fits.
Every text is scored whole; a task remembers the scores of the words it has
met in a bounded table, since a word's score does not depend on the text.

Words are maximal runs of letters, lower-cased, with the vocabulary's word
mark in front; a character that no piece covers is an unknown piece of its own.

Edge cases: a null text or one without a letter is ``und`` with score 0; ties
go to the language of more training texts, then the lesser name; without any
labelled row every text is ``und``; a row of null id is scored but not learnt
from; repeated rows score alike; very long words are summed in a sliding window;
an empty table gives an empty result; other columns are carried.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.store import materialize
from tillcast.sizing import broadcast_checked

MAX_ROWS = 8_000
ROUNDS = 3
SHORT = 24             # characters of a word whose sums stay far above the least double
UNKNOWN_COST = 2.0     # an unknown character is this many times less likely than an unseen piece
SMOOTHING = 0.1        # added to the expected count of every piece
CACHE_WORDS = 400_000
CACHE_CHARS = 16_000_000
MARK = "▁"             # word start in the vocabulary
UNDETERMINED = "und"
LETTERS = regex.compile(r"\p{L}+")
_PIECES: dict[str, Pieces] = {}
_TABLES: dict[int, dict] = {}  # the word table of the model in use, kept from task to task


class Pieces(dict):
    """Pieces by name, numbered from 1 (0 is the unknown character), and a hash table of
    them that looks up all substrings of many words at once."""

    def __init__(self, ids: dict[str, int]):
        super().__init__(ids)
        self.span = max(map(len, ids), default=1)
        size = 1 << max(8, (4 * len(ids)).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys, self.ids = np.zeros(size, dtype=np.uint64), np.full(size, -1, dtype=np.int32)
        by_length: dict[int, list[str]] = {}
        for p in ids:
            by_length.setdefault(len(p), []).append(p)
        for names in by_length.values():
            chars = code_points(names)
            h = np.zeros(len(names), dtype=np.uint64)
            for k in range(chars.shape[1]):
                h = _roll(h, chars[:, k])
            for p, key in zip(names, h.tolist()):
                slot = key & (size - 1)
                while self.ids[slot] >= 0:
                    if int(self.keys[slot]) == key:
                        raise ValueError(f"piece {p!r} has the hash of another one")
                    slot = (slot + 1) & (size - 1)
                self.keys[slot], self.ids[slot] = key, ids[p]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Ids of the pieces of these hashes; -1 where there is none."""
        slot = (h & self.mask).astype(np.int64)
        found = self.ids[slot]
        found[(found >= 0) & (self.keys[slot] != h)] = -2  # another piece sits there: look on
        at = np.nonzero(found == -2)
        while len(at[0]):
            slot[at] = (slot[at] + 1) & int(self.mask)
            ids = self.ids[slot[at]]
            ids[(ids >= 0) & (self.keys[slot[at]] != h[at])] = -2
            found[at] = ids
            again = ids == -2
            at = tuple(x[again] for x in at)
        return found


def code_points(words: list[str]) -> np.ndarray:
    """[word, character] of equally long words."""
    n = len(words[0])
    return np.array(words, dtype=f"<U{n}").view("<u4").reshape(len(words), n)


def _roll(h: np.ndarray, char: np.ndarray) -> np.ndarray:
    """Hash of a string with one more character."""
    h = (h + char + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def pieces(path: str) -> Pieces:
    """Pieces made of letters and the word mark, numbered from 1; 0 is the unknown character."""
    if path not in _PIECES:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_byte(i))
        plain = [p for p in names if LETTERS.fullmatch(p.replace(MARK, "", 1) or "a")]
        _PIECES[path] = Pieces({p: k for k, p in enumerate(dict.fromkeys(plain), 1)})
    return _PIECES[path]


def _lattice(words: list[str], known: Pieces) -> np.ndarray:
    """Piece ids [word, start, length - 1] of equally long words; -1 where no piece fits."""
    n = len(words[0])
    span = min(known.span, n)
    chars = code_points(words)
    out = np.full((len(words), n, span), -1, dtype=np.int32)
    h = np.zeros((len(words), n), dtype=np.uint64)
    for k in range(span):
        h = _roll(h[:, :n - k], chars[:, k:])
        out[:, :n - k, k] = known.find(h)
    single = out[:, :, 0]
    single[single < 0] = 0  # a character of its own is always possible
    return out


def _edge_probs(lattice: np.ndarray, probs: np.ndarray) -> np.ndarray:
    """Probability of each lattice edge per language (0 where there is no piece)."""
    return np.where(lattice[..., None] >= 0, probs[np.maximum(lattice, 0)], 0.0)


def _forward(edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scaled forward sums [word, position, language], log scale per word and
    language at each position). Each position is rescaled, so words of any length fit."""
    size, n, span, langs = edge.shape
    alpha = np.zeros((size, n + 1, langs))
    scale = np.zeros((size, n + 1, langs))
    alpha[:, 0] = 1.0
    for end in range(1, n + 1):
        k = min(span, end)
        # earlier sums, brought to the scale of position end - 1
        back = np.arange(end - 1, end - 1 - k, -1)
        shift = np.exp(scale[:, back] - scale[:, end - 1:end])
        total = (alpha[:, back] * shift * edge[:, back, np.arange(k)]).sum(axis=1)
        alpha[:, end] = 1.0
        scale[:, end] = scale[:, end - 1] + np.log(total)
    return alpha, scale


def _short_sums(lattice: np.ndarray, probs: np.ndarray) -> np.ndarray:
    """log P of words so short that their sums need no scale, [word, language]."""
    size, n, span = lattice.shape
    probs = np.concatenate([probs, np.zeros((1, probs.shape[1]))])  # -1: the row of zeros
    alpha = np.zeros((size, n + 1, probs.shape[1]))
    alpha[:, 0] = 1.0
    for end in range(1, n + 1):
        k = min(span, end)
        back = np.arange(end - 1, end - 1 - k, -1)
        alpha[:, end] = (alpha[:, back] * probs[lattice[:, back, np.arange(k)]]).sum(axis=1)
    return np.log(alpha[:, n])


def log_probs(words: list[str], known: Pieces, probs: np.ndarray) -> np.ndarray:
    """log P(word) summed over all segmentations, [word, language]."""
    out = np.zeros((len(words), probs.shape[1]))
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_length.setdefault(len(w), []).append(k)
    for n, rows in by_length.items():
        step = max(1, 200_000 // (n * min(n, known.span)))
        for a in range(0, len(rows), step):
            part = rows[a:a + step]
            out[part] = _word_log_probs([words[k] for k in part], known, probs)
    return out


def _word_log_probs(words: list[str], known: Pieces, probs: np.ndarray) -> np.ndarray:
    n = len(words[0])
    if n <= SHORT and probs.min() ** n > 1e-280:
        return _short_sums(_lattice(words, known), probs)
    if n <= 64:
        return _forward(_edge_probs(_lattice(words, known), probs))[1][:, -1]
    out = np.zeros((len(words), probs.shape[1]))
    for r, w in enumerate(words):  # a very long word: a sliding window of sums, memory independent of its length
        scale = np.zeros((known.span, probs.shape[1]))  # scale[k]: log sum k + 1 characters back
        scale[1:] = -np.inf
        for end in range(1, n + 1):
            ids = [known.get(w[end - k:end], -1) for k in range(1, min(known.span, end) + 1)]
            ids[0] = max(ids[0], 0)
            use = [k for k, i in enumerate(ids) if i >= 0]
            top = scale[0].copy()
            total = (np.exp(scale[use] - top) * probs[[ids[k] for k in use]]).sum(axis=0)
            scale[1:] = scale[:-1].copy()
            scale[0] = top + np.log(total)
        out[r] = scale[0]
    return out


def train(words: list[str], counts: np.ndarray, known: Pieces, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language by EM over words with counts."""
    probs = np.full((len(known) + 1, 1), 1.0 / (len(known) + 1))
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_length.setdefault(len(w), []).append(k)
    lattices = []
    for n, rows in by_length.items():
        step = max(1, 400_000 // (n * min(n, known.span)))
        for a in range(0, len(rows), step):
            part = rows[a:a + step]
            lattices.append((_lattice([words[k] for k in part], known), counts[part]))
    for _ in range(rounds):
        expected = np.full(len(known) + 1, SMOOTHING)
        for lattice, weight in lattices:
            size, n, span = lattice.shape
            edge = _edge_probs(lattice, probs)
            scale = _forward(edge)[1][..., 0]
            back = np.full((size, n + 1), -np.inf)
            back[:, n] = 0.0
            with np.errstate(divide="ignore"):
                log_edge = np.log(edge[..., 0])
            for start in range(n - 1, -1, -1):
                k = min(span, n - start)
                term = log_edge[:, start, :k] + back[:, start + 1:start + 1 + k]
                top = term.max(axis=1)
                back[:, start] = top + np.log(np.exp(term - top[:, None]).sum(axis=1))
            for k in range(span):
                post = np.exp(scale[:, :n - k] + log_edge[:, :n - k, k] + back[:, k + 1:] - scale[:, n:])
                on = lattice[:, :n - k, k] >= 0
                expected += np.bincount(lattice[:, :n - k, k][on], weights=(post * weight[:, None])[on], minlength=len(expected))
        probs = (expected / expected.sum())[:, None]
    probs[0] = min(probs[0, 0], SMOOTHING / expected.sum() / UNKNOWN_COST) if expected[0] <= 2 * SMOOTHING else probs[0, 0]
    return probs[:, 0]


TABLE = T.StructType([T.StructField("lang", T.StringType()), T.StructField("n_texts", T.LongType()),
                      T.StructField("probs", T.ArrayType(T.FloatType()))])


def words_column(text: Column) -> Column:
    """Lower-cased letter runs of a text, each with the word mark in front."""
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def letter_words(column: pa.Array) -> pa.Array:
        return pa.array([[MARK + w for w in LETTERS.findall((t or "").lower())] for t in column.to_pylist()], pa.list_(pa.string()))
    return letter_words(text)


def _least_per_language(labelled: DataFrame, max_rows: int) -> DataFrame:
    """The rows of the least hash of each language, ``max_rows`` shared equally. A bound on the hash that leaves about
    one and a half times a language's share goes first, so no task sorts a whole language."""
    sizes = materialize(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-sizes")
    share = max(1, max_rows // max(1, sizes.count()))
    bound = F.when(F.col("n") > 2 * share, F.lit(float(-(1 << 63))) + F.lit(float(1 << 64)) * (1.5 * share) / F.col("n"))
    near = labelled.join(broadcast_checked(sizes.select(F.col("lang").alias("_lang"), bound.alias("_bound"))), F.col("lang") == F.col("_lang"))
    near = near.filter(F.col("_bound").isNull() | (F.col("_order").cast("double") < F.col("_bound")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_order", "text"))
    return near.withColumn("_place", place).filter(F.col("_place") <= share).select("lang", "text")


def fit(docs: DataFrame, path: str, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        max_rows: int = MAX_ROWS, rounds: int = ROUNDS) -> list[tuple[str, int, np.ndarray]]:
    """(language, training texts, piece probabilities) for every language of ``docs``."""
    labelled = (docs.filter(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull())
                .select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"),
                        F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`")).alias("_order")))
    some = materialize(_least_per_language(labelled, max_rows).repartition(8), "language-sample")
    sizes = some.groupBy("lang").agg(F.count(F.lit(1)).alias("n_texts"))
    counted = (some.select("lang", F.explode(words_column(F.col("text"))).alias("word"))
               .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
               .join(F.broadcast(sizes), "lang"))  # one row per language of a bounded sample

    def fit_language(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("word")
        probs = train(rows["word"].tolist(), rows["n"].to_numpy(dtype=float), pieces(path), rounds)
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "n_texts": [rows["n_texts"].iloc[0]], "probs": [probs.astype(np.float32)]})

    found = counted.groupBy("lang").applyInPandas(fit_language, TABLE).collect()
    return sorted(((r["lang"], r["n_texts"], np.array(r["probs"], dtype=np.float64)) for r in found), key=lambda r: (-r[1], r[0]))


PREDICTION = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


def predict_column(text: Column, model, path: str) -> Column:
    """(language, posterior probability) of each text; ``model`` is a broadcast of ``fit``'s list."""
    uid = uuid.uuid4().int  # of the model: a reused worker keeps the table of one model

    @F.arrow_udf(PREDICTION)
    def predict(column: pa.Array) -> pa.Array:
        from tillcast.llm.language import _TABLES  # the worker's module, not a copy sent with the function

        names = [m[0] for m in model.value]
        state = _TABLES.get(uid)
        if names and state is None:
            _TABLES.clear()
            state = _TABLES[uid] = {"probs": np.stack([m[2] for m in model.value], axis=1), "rows": {}, "chars": 0,
                                    "scores": np.zeros((1 << 16, len(names)))}
        langs, scores = [], []
        for a in range(0, len(column), 256):
            found = [LETTERS.findall((t or "").lower()) for t in column.slice(a, 256).to_pylist()]
            if not names:
                langs += [UNDETERMINED] * len(found)
                scores += [0.0] * len(found)
                continue
            total = _text_scores(found, state, pieces(path))
            for words, row in zip(found, total):
                if not words:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                else:
                    best = int(np.argmax(row))
                    langs.append(names[best])
                    scores.append(float(1.0 / np.exp(np.clip(row - row[best], -700, 0)).sum()))
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])
    return predict(text)


def _text_scores(found: list[list[str]], state: dict, known: dict[str, int]) -> np.ndarray:
    """Sum of the word scores of each text, [text, language]. ``state`` keeps the
    row of each known word in a bounded table of scores."""
    rows = state["rows"]
    fresh = list({w for words in found for w in words if w not in rows})
    if len(rows) + len(fresh) > CACHE_WORDS or state["chars"] > CACHE_CHARS:
        rows.clear()
        state["chars"] = 0
        fresh = list({w for words in found for w in words})
    need = len(rows) + len(fresh)
    if need > len(state["scores"]):
        state["scores"] = np.concatenate([state["scores"], np.zeros((max(need - len(state["scores"]), len(state["scores"])), state["scores"].shape[1]))])
    if fresh:
        state["scores"][len(rows):need] = log_probs([MARK + w for w in fresh], known, state["probs"])
        rows.update(zip(fresh, range(len(rows), need)))
        state["chars"] += sum(map(len, fresh))
    at = np.fromiter((rows[w] for words in found for w in words), dtype=np.int64)
    ends = np.cumsum([0, *map(len, found)])
    out = np.zeros((len(found), state["scores"].shape[1]))
    full = np.flatnonzero(np.diff(ends))
    if len(full):
        out[full] = np.add.reduceat(state["scores"][at], ends[full], axis=0)
    return out


def held_out(ident: Column, folds: int = 4, fold: int = 2) -> Column:
    """True where crc32 of the id's text falls in the held-out fold; false for a null id."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, path: str, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
             max_rows: int = MAX_ROWS, rounds: int = ROUNDS, out: str = "prediction") -> DataFrame:
    """``docs`` plus a struct ``out`` of lang and score (a column of that name is replaced); learns from rows outside the held-out fold only."""
    learn = docs.filter(F.col(f"`{id_col}`").isNotNull() & ~held_out(F.col(f"`{id_col}`")))
    model = docs.sparkSession.sparkContext.broadcast(fit(learn, path, text_col, lang_col, id_col, max_rows, rounds))
    return docs.withColumn(out, predict_column(F.col(f"`{text_col}`"), model, path))
