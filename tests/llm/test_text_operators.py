"""Operators on documents against brute force, on awkward small tables."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.cases import AWKWARD, CLASH, document_schema, documents, prose
from tillcast.llm import bpe, decontaminate, language, simhash, substring, suffix, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def awkward(spark):
    return documents(spark, AWKWARD, CLASH)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], document_schema(CLASH))


# -- BPE ------------------------------------------------------------------

def test_bpe_equals_library(awkward):
    lib = Tokenizer.from_file(PATH)
    rows = (bpe.encode_and_decode(awkward.withColumn("coded", F.lit(1)), PATH)
            .select("text", F.col("coded").alias("both"), bpe.encode(F.col("text"), PATH).alias("ids"))
            .select("text", "ids", "both", bpe.decode(F.col("ids"), PATH).alias("back")).collect())
    assert len(rows) == len(AWKWARD)
    for r in rows:
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids
        assert r["back"] == r["both"]["decoded"] == lib.decode(ids, skip_special_tokens=False)
        assert bytes(r["both"]["ids"]) == np.array(ids, "<u4").tobytes()


def test_bpe_empty_table(empty):
    assert empty.select(bpe.decode(bpe.encode(F.col("text"), PATH), PATH)).count() == 0


def test_tree_concatenation_is_exact():
    lib, coder = Tokenizer.from_file(PATH), bpe.Coder(PATH, unsplit=7)
    r = random.Random(5)
    parts = ["a", "b", "ab", "the", "é", "'s", "!", "1", "日本", "<|endoftext|>", "İ", "ß", "é", "́", "ing", "A", "ſ", "😀", "'", "\x1c", "​", "ª", "no.", "Ê,"]
    for _ in range(1500):
        some = r.sample(parts, r.randint(1, 6))
        run = "".join(r.choice(some) for _ in range(r.randint(4, 90)))
        assert np.frombuffer(coder.encode_texts([run])[0], "<u4").tolist() == lib.encode(run, add_special_tokens=False).ids, run


def test_decode_leaves_out_unknown_ids(spark):
    df = spark.createDataFrame([([320, 10**6, -1, 49407],), (None,), ([],)], "ids array<int>")
    assert [r[0] for r in df.select(bpe.decode(F.col("ids"), PATH)).collect()][1:] == ["", ""]


# -- SimHash --------------------------------------------------------------

def _fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(ids, linked):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(ids)):
        groups[find(i)].append(ids[i])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [least[find(i)] for i in range(len(ids))]


def test_simhash_equals_brute_force(awkward):
    rows = simhash.simhash_groups(awkward).select("doc_id", "text", "near_copies.*").collect()
    fps = [_fingerprint(r["text"]) for r in rows]
    assert [r["fingerprint"] for r in rows] == [f"{f:016x}" for f in fps]
    want = _components([r["doc_id"] for r in rows], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    assert [r["component_id"] for r in rows] == want
    heads = Counter((r["component_id"], r["fingerprint"]) for r in rows if r["is_first"])
    assert sum(heads.values()) == len(set(zip(want, [None if w is not None else f for w, f in zip(want, fps)])))


@pytest.mark.parametrize("cap", [1, 64])
def test_simhash_links_keep_components(spark, cap):
    """Random clusters a few bits apart, with sparse and with dense cells."""
    r = random.Random(cap)
    fps = set()
    for _ in range(40):
        x = r.getrandbits(64)
        for _ in range(r.randint(1, 12)):
            fps.add(x)
            x ^= 1 << r.randrange(64)
            if r.random() < 0.5:
                x ^= 1 << r.randrange(64)
            if r.random() < 0.3:
                x ^= 1 << r.randrange(64)
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    got = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(df, cell_cap=cap).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in got)
    at = {x: i for i, x in enumerate(fps)}
    linked = {frozenset((at[a], at[b])) for a, b in got}
    assert _components(fps, lambda i, j: frozenset((i, j)) in linked) == _components(fps, lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)


def test_manhattan_is_a_lower_bound(spark):
    r = random.Random(1)
    pairs = [(simhash._signed(r.getrandbits(64)), simhash._signed(r.getrandbits(64))) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a long, b long")
    counts = lambda x: [(x >> (2 * s) & 3).bit_count() for s in range(32)]
    d = df.select("a", "b", simhash.manhattan(simhash.segment_counts(F.col("a")), simhash.segment_counts(F.col("b"))).alias("d")).collect()
    for x in d:
        a, b = x["a"] % 2**64, x["b"] % 2**64
        assert x["d"] == sum(abs(i - j) for i, j in zip(counts(a), counts(b))) <= (a ^ b).bit_count()


def test_simhash_empty_table(empty):
    assert simhash.simhash_groups(empty).count() == 0


# -- decontamination ------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def _brute_hits(text, items, n=13):
    w, hit, ids = _words(text), set(), set()
    for i, t in items:
        v = _words(t)
        size = min(n, len(v))
        windows = {tuple(v[k:k + size]) for k in range(len(v) - size + 1)} if size else set()
        for k in range(len(w) - size + 1 if size else 0):
            if tuple(w[k:k + size]) in windows:
                hit |= set(range(k, k + size))
                if i is not None:
                    ids.add(str(i))
    return len(w), len(hit), sorted(ids)


BENCH = [(1, prose(100, 30)), (2, prose(101, 13)), (10, "short item"), (3, None), (4, ""), (None, prose(102, 20)), (5, prose(100, 30)), (6, "!!!")]


@pytest.mark.parametrize("block", [1_000_000, 20])
def test_decontaminate_equals_brute_force(spark, awkward, block):
    more = [(20, prose(20, 60) + " " + re.sub("[a-z]", lambda m: m[0].upper(), prose(100, 30)) + " " + prose(21, 40)), (21, "Short, ITEM! " * 3), (22, prose(22, 500) + prose(101, 13)),
            (23, " ".join(prose(100, 30).split()[5:17])), (24, prose(102, 20)), (25, prose(100, 30) + " " + prose(100, 30))]
    docs = awkward.unionByName(documents(spark, more, CLASH))
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    rows = decontaminate.find_contamination(docs, bench, block_windows=block).collect()
    assert len(rows) == len(AWKWARD) + len(more)
    for r in rows:
        c = r["contamination"]
        n, hit, ids = _brute_hits(r["text"], BENCH)
        assert (c["n_words"], c["n_hit"], c["items"]) == (n, hit, ids), r["doc_id"]
        assert c["contaminated"] == (hit > 0 and 20 * hit >= n)
    found = decontaminate.find_contamination(docs, bench)
    clean = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(found).collect()}
    assert _brute_hits(clean[20], [BENCH[0]])[1] == 0 and clean[6] == prose(6, 300) and clean[1] is None
    assert {20, 24, 25}.isdisjoint(r["doc_id"] for r in decontaminate.remove_documents(found).collect())


def test_decontaminate_empty_tables(spark, empty, awkward):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert decontaminate.find_contamination(empty, bench).count() == 0
    none = decontaminate.find_contamination(awkward, bench.limit(0)).collect()
    assert len(none) == len(AWKWARD) and all(r["contamination"]["n_hit"] == 0 for r in none)


# -- suffix arrays ------------------------------------------------------------------

def _brute_removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append((len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("hot", [4096, 1])
def test_suffix_dedup_equals_brute_force(spark, hot):
    passage = prose(77, 60)
    rows = [r for r in AWKWARD if r[0] != 8] + [(30 + k, prose(30 + k, 40) + passage[k:] + prose(50 + k, 30)) for k in range(8)]
    rows += [(60, "ab" * 300), (61, "ab" * 150), (62, "x" * 199), (63, "x" * 200), (64, "x" * 201), (65, "é" * 120), (66, "é" * 130)]
    docs = documents(spark, rows, CLASH)
    got = suffix.remove_repeats(docs, hot_contexts=hot, shard_bytes=2000).select("unique.*").collect()
    want = _brute_removed([r[1] for r in rows], suffix.LENGTH)
    assert Counter((g["n_bytes"], g["n_removed"], g["n_spans"], bytes(g["kept"])) for g in got) == Counter(want)


def test_suffix_array_order():
    r = random.Random(2)
    for k in range(200):
        some = r.choice([b"ab", b"a", b"abcdefgh"])
        text = bytes(r.choice(some) for _ in range(r.randint(0, 200))) + b"\0"
        got = suffix.suffix_array(np.frombuffer(text, np.uint8), 256).tolist()
        assert got == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_empty_table(empty):
    assert suffix.remove_repeats(empty).count() == 0


# -- substring dedup -------------------------------------------------------------------

def test_substring_removes_planted_passages(spark):
    passage, line = prose(7, 80), prose(8, 120)
    edited = line.split()
    edited[60] = "changed"
    rows = [(1, prose(1, 70) + "\n" + prose(11, 100)), (2, prose(2, 60) + " " + passage + " " + prose(3, 60)), (3, passage),
            (4, prose(4, 90) + "\n" + prose(5, 30) + " " + passage), (5, line + "\n" + prose(66, 55)), (6, prose(9, 55) + "\n" + " ".join(edited)),
            (7, prose(12, 40)), (8, prose(13, 20) + "\n" + prose(12, 40))]
    rows += [r for r in AWKWARD if r[0] not in (8, 9)]
    rows = [(100 + i if i is not None and k >= 8 else i, t) for k, (i, t) in enumerate(rows)]
    out = {}
    for r in substring.remove_repeats(documents(spark, rows, CLASH)).collect():
        out.setdefault(r["doc_id"], []).append(r)
    text = {k: v[0]["text"] for k, v in out.items()}
    source = dict(rows)
    assert passage in text[2] and passage not in text[4] and text[3] == ""
    assert text[4].startswith(prose(4, 90) + "\n" + prose(5, 30))
    assert line in text[5] and "changed" not in text[6] and text[6].startswith(prose(9, 55))
    assert out[4][0]["repeats"]["kept_in"] == [2] and out[6][0]["repeats"]["kept_in"] == [5]
    for clean in (1, 2, 5, 7, 8, 101, 102, 103, 110):  # short repeats stay, so does everything that occurs once
        assert text[clean] == source[clean], clean
    assert [r["text"] for r in out[106]].count(source[106]) == 1 and out[107][0]["text"] == ""  # repeated rows: the first stays


def test_substring_dense_buckets(spark):
    """Many variants of one line: the same removals whether buckets count as dense or not."""
    base = prose(9, 100).split()
    rows = []
    for k in range(30):
        w = list(base)
        w[3 * k] = f"edit{k}"
        rows.append((k, " ".join(w)))
    for cap in (64, 2):
        kept = [r["doc_id"] for r in substring.remove_repeats(documents(spark, rows), bucket_cap=cap).collect() if r["text"]]
        assert kept == [0]


def test_substring_dense_buckets_link_through_members_that_agree(spark):
    """Copies that resemble the original but not its other copies, in buckets of any size."""
    words = [f"w{k}" for k in range(100)]
    r = random.Random(5)
    rows = [(0, " ".join(words))]
    for k in range(1, 201):
        w = list(words)
        w[r.randrange(5, 45)], w[r.randrange(55, 95)] = f"one{k}", f"two{k}"
        rows.append((k, " ".join(w)))
    rows = [(k, ". ".join([" ".join(t.split()[:50]), " ".join(t.split()[50:])]) + ".") for k, t in rows]
    sets = [set(zip(*(t.replace(".", "").split()[i:] for i in range(5)))) for _, t in rows]
    linked, todo = {0}, [0]
    while todo:
        x = todo.pop()
        found = {y for y in range(len(rows)) if y not in linked and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])}
        linked |= found
        todo += found
    assert len(linked) == len(rows)
    kept = [q["doc_id"] for q in substring.remove_repeats(documents(spark, rows)).collect() if q["text"]]
    assert 0 in kept and len(kept) <= 5  # the bands meet for all but a few thousandths of the pairs at 0.81


def test_substring_short_sentences(spark):
    """Passages made of sentences of fewer than five words: in one line, over many lines, and inside other text."""
    words = [w for w in prose(31, 400).replace(".", "").lower().split()]
    line = ". ".join(" ".join(words[k:k + 4]) for k in range(0, 80, 4)) + "."
    verse = "\n".join(" ".join(words[k:k + 1 + k % 4]) for k in range(100, 180))
    rows = [(0, line), (1, line), (2, verse), (3, verse), (4, prose(32, 60) + "\nSo it\n" + verse + "\nThe end\n" + prose(33, 60))]
    text = {r["doc_id"]: r["text"] for r in substring.remove_repeats(documents(spark, rows)).collect()}
    assert text[0] == line and text[2] == verse and text[1] == text[3] == ""
    assert text[4] == prose(32, 60) + "\nSo it\n\nThe end\n" + prose(33, 60)


def test_substring_cuts_by_content(spark):
    """Passages that keep to no sentence or line border, edits in neighbouring sentences, other line widths."""
    plain = lambda seed, n: prose(seed, n).replace(".", "").lower()
    stretch, inside = plain(41, 60), prose(42, 55)
    ten = [plain(430 + k, 10) for k in range(10)]
    edited = [t.split() for t in ten]
    edited[4][5], edited[5][5] = "changed", "altered"
    ten, edited = ". ".join(ten) + ".", ". ".join(" ".join(t) for t in edited) + "."
    words = plain(44, 200).split()
    wrap = lambda n: "\n".join(" ".join(words[k:k + n]) for k in range(0, 200, n))
    rows = [(0, plain(51, 40) + " " + stretch + " " + plain(52, 40)), (1, plain(53, 30) + " " + stretch + " " + plain(54, 50)),
            (2, prose(55, 70) + "\n" + plain(56, 7) + " " + inside + " " + prose(57, 20)), (3, plain(58, 9) + " " + inside + " " + prose(59, 70)),
            (4, prose(60, 60) + " " + ten + " " + prose(61, 60)), (5, prose(62, 60) + " " + edited + " " + prose(63, 60)),
            (6, wrap(9)), (7, wrap(12))]
    text = {r["doc_id"]: r["text"] for r in substring.remove_repeats(documents(spark, rows)).collect()}
    source = dict(rows)
    assert all(text[k] == source[k] for k in (0, 2, 4, 6))
    assert text[1] == plain(53, 30) + "  " + plain(54, 50)
    assert text[3].split() == (plain(58, 9) + " " + prose(59, 70)).split()
    assert text[5].split() == (prose(62, 60) + " " + prose(63, 60)).split()
    assert text[7] == ""


def test_substring_recall_of_banding():
    """Bands meet for nearly all pairs at the similarity threshold."""
    r = random.Random(4)
    met = 0
    for _ in range(200):
        both = [r.getrandbits(64) for _ in range(80)]
        a, b = both + [r.getrandbits(64) for _ in range(10)], both + [r.getrandbits(64) for _ in range(10)]
        sh = np.array(a + b, dtype=np.uint64)
        sig = substring.signature(sh, np.array([0, 90]), np.array([90, 180]), substring.BANDS, substring.ROWS)
        met += bool((sig[0] == sig[1]).any())
    assert met >= 190


def test_substring_empty_table(empty):
    assert substring.remove_repeats(empty).count() == 0


# -- toxicity ------------------------------------------------------------------------------

def _toxic_corpus(spark):
    r, rows, labels = random.Random(3), [], []
    for k in range(400):
        t, bad = prose(1000 + k, 40), k % 4 == 0
        if bad:
            w = t.split()
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["vilewort", "nastyness", "grimly"]))
            t = " ".join(w)
        rows.append((k, t))
        labels.append((k, int(bad)))
    return rows, labels


def test_toxicity_learns_and_scores_every_row(spark):
    rows, labels = _toxic_corpus(spark)
    docs = documents(spark, rows + [(1000 + (i or 0), t) for i, t in AWKWARD] + [(None, "no id")], [*CLASH, "toxicity"])
    lab = spark.createDataFrame(labels + [(5, None), (None, 1), (8, 1)], "doc_id long, toxic int")
    got = toxicity.classify(docs, lab).select("doc_id", "toxicity", toxicity.held_out(F.col("doc_id")).alias("held")).collect()
    assert len(got) == docs.count() and all(0 <= r["toxicity"] <= 1 for r in got)
    truth = dict(labels)
    held = [(truth[r["doc_id"]], r["toxicity"]) for r in got if r["doc_id"] in truth and r["held"]]
    assert len(held) > 40 and sum((s >= 0.5) == bool(t) for t, s in held) >= 0.95 * len(held)


def test_toxicity_without_labels_or_rows(spark, empty, awkward):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.classify(empty, none).count() == 0
    assert all(r["toxicity"] < 0.5 for r in toxicity.classify(awkward, none).collect())


# -- language ---------------------------------------------------------------------------------

def _brute_log_prob(word, known, probs):
    total = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - 16), end):
            i = known.get(word[start:end], 0 if end - start == 1 else None)
            if i is not None:
                total[end] += total[start] * probs[i]
    return np.log(total[-1])


def test_forward_sums_all_segmentations():
    known = language.pieces(PIECES)
    probs = np.random.default_rng(1).dirichlet(np.ones(len(known) + 1), size=2).T
    words = ["▁the", "▁a", "▁straße", "▁日本", "▁" + "abc" * 40, "▁unbelievable"]
    got = language.log_probs(words, known, probs)
    want = [[_brute_log_prob(w, known, probs[:, k]) for k in range(2)] for w in words]
    assert np.allclose(got, want, rtol=1e-9)


def test_language_held_out_accuracy(spark):
    stems = {"aa": ["sol", "mar", "luz", "casa", "perro"], "bb": ["haus", "baum", "stadt", "licht", "hund"], "cc": ["kuu", "talo", "puu", "vesi", "koira"]}
    ends = {"aa": ["a", "o", "es"], "bb": ["en", "er", "ung"], "cc": ["ssa", "lla", "ksi"]}
    r, rows = random.Random(6), []
    for k in range(300):
        lang = ["aa", "bb", "cc"][k % 3]
        rows.append((k, " ".join(r.choice(stems[lang]) + r.choice(ends[lang]) for _ in range(12)), lang))
    extra = [(1000, None, "aa"), (1001, "12 34 ²", "bb"), (1002, "", None), (1003, "haus" * 4000, None), (None, "talossa", None), (1004, "日本", None)]
    docs = documents(spark, rows + extra, [*CLASH, "prediction"])
    got = language.identify(docs, PIECES).select("doc_id", "lang", "prediction.*", language.held_out(F.col("doc_id")).alias("held")).toDF(
        "doc_id", "lang", "pred", "score", "held").collect()
    assert len(got) == len(rows) + len(extra)
    held = [r for r in got if r["held"] and r["doc_id"] < 1000]
    assert held and sum(r["pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    by = {r["doc_id"]: r for r in got}
    assert all((by[k]["pred"], by[k]["score"]) == ("und", 0.0) for k in (1000, 1001, 1002)) and by[1003]["pred"] == "bb" and by[None]["pred"] == "cc"


def test_language_empty_and_unlabelled(spark, empty, awkward):
    assert language.identify(empty, PIECES).count() == 0
    none = language.identify(awkward.withColumn("lang", F.lit(None).cast("string")), PIECES).collect()
    assert all(r["prediction"]["lang"] == "und" for r in none)


# -- substring dedup against brute force ------------------------------------------------------

def _family(seed, size, words=120, edits=3, base=None):
    """Variants of one passage, each with some words replaced."""
    r = random.Random(seed)
    base = base or [f"w{r.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(size):
        own = list(base)
        for k in r.sample(range(words), edits):
            own[k] = f"x{r.randrange(10**9)}"
        out.append(" ".join(own))
    return base, out


def _linked(spark, texts, **options):
    """Components that the operator's links give, by text."""
    from tillcast.llm.components import connected_components
    marks = spark.createDataFrame([], "uid long, repeated array<struct<pos:int,n:long>>")
    edges = spark.createDataFrame([], "uid long, edge array<struct<pos:int,n:long>>")
    docs = spark.createDataFrame(list(enumerate(texts)), "uid long, text string")
    found = substring.materialize(substring.paragraph_rows(docs, marks, edges, "uid", "text", 50, 5, substring.BANDS, substring.ROWS), "test-paragraphs")
    roots = {r["node"]: r["root"] for r in connected_components(spark, substring.links(found, **options)).collect()}
    return {r["uid"]: roots.get(r["digest"], r["digest"]) for r in found.select("uid", "digest").collect()}


def _brute_components(texts, least=0.8):
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared >= least * (len(sets[i]) + len(sets[j]) - shared):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("cap", [64, 8])
def test_links_give_the_components_of_brute_force(spark, cap):
    base, one = _family(1, 30, edits=2)
    _, two = _family(2, 30, edits=2, base=base[:80] + [f"q{k}" for k in range(40)])  # shares two thirds of the first family
    _, three = _family(3, 12, edits=1)
    texts = one + two + three + [" ".join(f"z{k}{j}" for j in range(60)) for k in range(10)]
    got, want = _linked(spark, texts, bucket_cap=cap), _brute_components(texts)
    by_got, by_want = {}, {}
    for i in range(len(texts)):
        by_got.setdefault(got[i], set()).add(i)
        by_want.setdefault(want[i], set()).add(i)
    assert sorted(map(sorted, by_got.values())) == sorted(map(sorted, by_want.values()))


def test_pairs_of_two_families_grow_linearly(spark, monkeypatch):
    """A family that shares a dense bucket with a more frequent one is not compared pair by pair."""
    counts, real = [], substring._verified
    monkeypatch.setattr(substring, "_verified", lambda pairs, *rest: counts.append(pairs) or real(pairs, *rest))
    totals = []
    for size in (100, 200):
        base, one = _family(4, size, edits=1)
        _, two = _family(5, size, edits=1, base=base[:80] + [f"q{k}" for k in range(40)])
        counts.clear()
        got = _linked(spark, one + two, bucket_cap=8)
        assert len({got[i] for i in range(size)}) == 1 and len({got[i] for i in range(size, 2 * size)}) == 1
        totals.append(sum(p.count() for p in counts))
    assert totals[1] <= 2.5 * totals[0], totals


def test_open_members_of_a_dense_bucket_make_few_rows(spark, monkeypatch):
    """Paragraphs that share a hot passage and resemble nothing meet again by the few shingles that others hold too."""
    rows, real = {}, substring.materialize

    def kept(df, name, **options):
        out = real(df, name, **options)
        rows[name] = out.count()
        return out
    monkeypatch.setattr(substring, "materialize", kept)
    base, alone = _family(7, 150, edits=8)
    pair = _family(8, 2, edits=1, base=alone[0].split())[1]  # they resemble each other, and the first
    texts = alone + pair
    got, want = _linked(spark, texts, bucket_cap=8), _brute_components(texts)
    assert [[got[i] == got[j] for j in range(i)] for i in range(len(texts))] == [[want[i] == want[j] for j in range(i)] for i in range(len(texts))]
    assert max(n for name, n in rows.items() if name != "test-paragraphs") <= 12 * len(texts), rows


def test_similar_paragraphs_share_a_shingle_of_their_prefixes(spark):
    import zstandard
    _, texts = _family(12, 40, words=150, edits=1)
    texts += _family(13, 20, words=150, edits=20)[1]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    rows = [(i, bytearray(zstandard.ZstdCompressor().compress(t.encode()))) for i, t in enumerate(texts)]
    packed = spark.createDataFrame(rows, "i int, packed binary")
    counts = substring.shingle_counts(packed, 5)
    assert counts.sum() == sum(map(len, sets))
    made = packed.select("i", substring.prefixes(F.col("packed"), spark.sparkContext.broadcast(counts), 5, 0.8).alias("p")).collect()
    by = {r["i"]: {k["key"]: k for k in r["p"]} for r in made}
    similar = 0
    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared):
                similar += 1
                first = min(by[i].keys() & by[j].keys(), key=lambda k: by[i][k]["pos"])
                x, y = by[i][first], by[j][first]
                assert 1.8 * min(x["size"] - x["pos"], y["size"] - y["pos"]) >= 0.8 * (x["size"] + y["size"]) - 1e-6
    assert similar > 20


def test_compared_pairs_are_held_some_at_a_time():
    """A batch of pairs of 10 KB each stays Arrow data but for the pairs at work."""
    import tracemalloc

    import pyarrow as pa
    import zstandard
    draw = random.Random(3)
    text = " ".join(f"{draw.getrandbits(64):x}" for _ in range(1200))
    one, other = (zstandard.ZstdCompressor(level=3).compress(t.encode()) for t in (text, text.rsplit(" ", 1)[0]))
    a, b = pa.array([one] * 3000, pa.binary()), pa.array([other] * 3000, pa.binary())
    tracemalloc.start()
    out = substring.overlaps(a, b, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.field("shared").to_pylist() == [1195] * 3000 and out.field("total").to_pylist() == [1196] * 3000
    assert peak < 16 << 20  # 3,000 pairs take over 50 MB


def _sketched(spark, texts):
    import zstandard
    rows = [(i, bytearray(zstandard.ZstdCompressor().compress(t.encode()))) for i, t in enumerate(texts)]
    made = spark.createDataFrame(rows, "i int, packed binary").withColumn("s", substring.sketches(F.col("packed"), 5))
    return [bytes(r["s"]) for r in made.orderBy("i").select("s").collect()]


def test_sketches_rule_out_only_pairs_that_cannot_be_similar(spark):
    import pyarrow as pa
    draw = random.Random(9)
    base = [draw.choice(["lorem", "Ipsum", "dolor", "éa", "x9"]) + str(draw.randrange(60)) for _ in range(150)]
    texts = [" ".join(base)] + [" ".join(w if draw.random() > share else w + "q" for w in base)
                                for share in (0.005, 0.02, 0.03, 0.05, 0.1, 0.3) for _ in range(12)]
    texts += ["again " * 400, "again " * 70, "", "Two words", "two WORDS", " ".join(base * 150)]  # repeats, too few words, full bins
    made, sets = _sketched(spark, texts), [substring._shingle_set(t.encode(), 5) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i)]
    kept = substring.may_reach(*(pa.array([made[p[k]] for p in pairs], pa.binary()) for k in (0, 1)), 0.8)
    similar = np.array([len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for i, j in pairs])
    assert similar.sum() > 50 and kept[similar].all()
    assert kept.sum() < similar.sum() + 0.15 * (~similar).sum()


def test_shingles_are_the_words_as_written():
    for text in ("One, two;THREE four\nfive six", "a b c d", "", "Été déjà 3,5 à la", "x " * 30):
        words = [w.decode() for w in re.findall(rb"[0-9a-z\x80-\xff]+", bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()))]
        want = {" ".join([*words[i:i + 5], ""]).encode() for i in range(len(words) - 4)}
        assert substring._shingle_set(text.encode(), 5) == want


def test_toxicity_bounds_the_bytes_of_a_batch(spark):
    """Long texts reach Python some megabytes at a time, not 10,000 rows at a time."""
    docs = spark.range(2000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 1000).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    scored = toxicity.classify(docs, labels, max_rows=20)
    sizes = [r["n"] for r in scored.mapInArrow(_batch_bytes, "n long").collect()]
    assert scored.filter("toxicity IS NOT NULL").count() == 2000
    assert sum(sizes) > 20 << 20 and max(sizes) < 8 << 20, max(sizes)


def _batch_bytes(batches):
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])
