"""Fill-in-the-middle, exact dedup and the Merkle manifest against brute force."""

import random
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import AWKWARD, CLASH, documents, prose
from tillcast.llm import exact, fim, merkle

LONG = [(20, "aé" * 40_000), (21, "日" * 30_000 + "x" * 70_000), (22, prose(3, 9000) * 3), (23, "<P>"), (24, "a<S>b"), (25, "<"), (26, "<P" * 50), (27, "S>" * 50)]


# -- fill-in-the-middle ---------------------------------------------------

@pytest.mark.parametrize("text", ["", "a", "é", "x" * 65_536, "x" * 65_535 + "é", "é" * 40_000, "ab日" * 50_000, "日" * 5000 + "x" * 100_000 + "é" * 9])
def test_borders(text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    found = fim.BoundarySet(data)
    want = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    assert len(found) == len(text)
    for k in {0, len(text), *random.Random(1).choices(range(len(text) + 1), k=300)}:
        assert found.select(k) == want[k]


def test_container_kinds():
    r = np.random.default_rng(0)
    for member, kind in ((np.ones(100, bool), fim._Runs), (r.random(1 << 16) < 0.01, fim._Array), (r.random(1 << 16) < 0.5, fim._Bitmap),
                         (np.arange(1 << 16) % 5000 < 4000, fim._Runs)):
        held, want = fim.container(member), np.flatnonzero(member)
        assert type(held) is kind
        assert [held.select(k) for k in range(0, len(want), 7)] == want[::7].tolist()


def plain_cut(doc_id, text):
    text = text or ""
    h = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle(spark):
    rows = AWKWARD + LONG + [(100 + k, prose(k, k % 30) + "é" * (k % 3)) for k in range(150)]
    docs = documents(spark, rows, CLASH)
    done = fim.fill_in_middle(docs)
    assert done.columns == [*docs.columns, "fim"]
    again = fim.restore(F.col("fim.output"), F.col("fim.form"))
    out = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["text"] or "", tuple(r["fim"])) for r in done.collect())
    want = sorted(((i is None, i or 0), t or "", plain_cut(i, t)) for i, t in rows)
    assert out == want
    assert {w[2][1] for w in want} == {"plain", "psm", "spm"}
    assert done.filter(again != F.coalesce("text", F.lit(""))).count() == 0
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
    assert fim.fill_in_middle(done, keep_text=False).columns == [c for c in done.columns if c != "text"]


def test_sentinels_that_overlap(spark):
    docs = documents(spark, [(1, "some text")])
    for bad in (("<P>", "<P>>", "<M>"), ("aba", "bab", "c"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(docs, sentinels=bad)
    kept = fim.fill_in_middle(docs, sentinels=("{pre}", "[suf]", "(mid)"))
    assert kept.select(fim.restore(F.col("fim.output"), F.col("fim.form"), ("{pre}", "[suf]", "(mid)"))).first()[0] == "some text"


# -- exact dedup ----------------------------------------------------------

def test_fingerprints_compose():
    import pyarrow as pa
    r = random.Random(5)
    for _ in range(40):
        a, b = (bytes(r.randrange(256) for _ in range(r.randrange(40))) for _ in range(2))
        whole, left, right = (exact.chunk_hashes(pa.array([x], pa.binary()), 0, exact.PRIMES) for x in (a + b, a, b))
        for k, p in enumerate(exact.PRIMES):
            base = exact.bases(0)[k]
            assert int(whole[2 * k][0]) == (int(left[2 * k][0]) * int(right[2 * k + 1][0]) + int(right[2 * k][0])) % p
            slow = 0
            for byte in a + b:
                slow = (slow * base + byte + 1) % p
            assert slow == int(whole[2 * k][0])


def groups_of(rows):
    by = defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in by.items()}
    return by, keep


def check_groups(rows, out):
    by, keep = groups_of(rows)
    assert len(out) == len(rows)
    kept = defaultdict(int)
    for r in out:
        t = r["text"] or ""
        assert (r["copies"]["keep_id"], r["copies"]["group_size"]) == (keep[t], len(by[t]))
        if r["copies"]["kept"]:
            assert r["doc_id"] == keep[t]
            kept[t] += 1
    assert dict(kept) == {t: 1 for t in by}


@pytest.mark.parametrize("primes, chunk", [(exact.PRIMES, exact.CHUNK), (exact.PRIMES, 1000), ((5, 7), 1000), ((2, 3), 64)])
def test_exact_groups(spark, primes, chunk):
    """Small primes make nearly all texts of a length collide; small chunks send texts through the distributed hash."""
    rows = AWKWARD + [(100 + k, prose(k % 40, 30)) for k in range(120)] + [(300 + k, f"w{k % 13:03d}") for k in range(60)] + [(400 + k, "copy of one text") for k in range(700)]
    rows += [(2000, "ab" * 600 + "x"), (2001, "ab" * 600 + "y"), (2002, "ab" * 600 + "x"), (-5, "ab" * 600 + "y")]
    docs = documents(spark, rows, CLASH)
    done = exact.exact_groups(docs, primes=primes, chunk=chunk)
    assert done.columns == [*docs.columns, "copies"]
    check_groups(rows, done.collect())


def test_exact_groups_of_nothing(spark):
    docs = documents(spark, [], ["copies", "uid"])
    done = exact.exact_groups(docs)
    assert done.count() == 0 and done.columns == ["doc_id", "text", "lang", "source", "n_chars", "uid", "copies"]


# -- Merkle manifest ------------------------------------------------------

def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """Levels of a tree, and each leaf's steps."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([digest(*at[i:i + 2]) for i in range(0, len(at), 2)])
    steps = []
    for k in range(len(leaves)):
        path = []
        for at in levels[:-1]:
            other = k ^ 1
            path.append("-" if other >= len(at) else ("L" if k % 2 else "R") + at[other])
            k //= 2
        steps.append(path)
    return levels[-1][0], steps


def brute_manifest(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    by = defaultdict(list)
    for r in rows:
        by[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, digest(*[field(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")])))
    names = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    subs = {g: tree([x[2] for x in sorted(by[g])]) for g in names}
    root, tops = tree([subs[g][0] for g in names])
    found = []
    for g, top in zip(names, tops):
        for at, (x, path) in enumerate(zip(sorted(by[g]), subs[g][1])):
            found.append(((x[0], x[1]), x[2], at, path + top, subs[g][0], root))
    return sorted(found)


@pytest.mark.parametrize("levels", [1, 3, 12])
def test_manifest(spark, levels):
    rows = [(i, t, random.Random(str(i)).choice(["en", "de", None, "é", "Z", ""])) for i, t in AWKWARD] + [(100 + k, f"t{k}", "en") for k in range(37)]
    rows += [(200 + k, None, f"l{k}") for k in range(9)] + [(300, "same", "en")] * 3 + [(400 + k, "x", "de") for k in range(16)]
    docs = documents(spark, rows, CLASH)
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    done = merkle.manifest(docs, fields, levels=levels)
    assert done.columns == [*docs.columns, "merkle"]
    got = done.collect()
    out = sorted(((r["doc_id"] is not None, r["doc_id"] or 0), *[r["merkle"][c] for c in ("leaf", "position", "witness", "subroot", "root")]) for r in got)
    assert out == brute_manifest(docs.collect())
    whole = done.select(merkle.fold(F.col("merkle.leaf"), F.col("merkle.witness")).alias("f"), "merkle.root")
    assert whole.filter("f != root").count() == 0
    changed = done.select(merkle.fold(F.sha2(F.col("merkle.leaf"), 256), F.col("merkle.witness")).alias("f"), "merkle.root")
    assert changed.filter("f = root").count() == 0


def test_manifest_of_nothing_and_of_one(spark):
    fields = ["doc_id", "text"]
    assert merkle.manifest(documents(spark, []), fields).count() == 0
    one = merkle.manifest(documents(spark, [(1, "a")]), fields, keep=["doc_id"])
    assert one.columns == ["doc_id", "merkle"]
    r = one.first()["merkle"]
    assert r["witness"] == [] and r["leaf"] == r["subroot"] == r["root"] == digest("1:1", "1:a")
