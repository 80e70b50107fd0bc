"""Each operator against a brute-force version, and on odd tables."""

import collections
import hashlib
import re
import struct

import numpy as np
import pytest

from inspecta.llm import (base, decontaminate, exact_dedup, html_extract, language_id, secret_scan, sentencepiece_bpe,
                          simhash_dedup, substring_dedup, suffix_dedup, toxicity, windows)
from inspecta.llm.components import components
from inspecta.llm.registry import QUERIES, piece_model
from inspecta.llm.sketch import Shape
from inspecta.session import scratch_dir
from tests.conftest import SF_SMOKE

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, X_SHA string, kept string, key int"


def sha(b) -> str:
    return hashlib.sha256(b.encode() if isinstance(b, str) else b).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None, "x", "y", 1) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMOKE}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# null, empty, repeated rows, a null id, a long text and characters beyond the basic plane
ODD = [(1, None), (2, ""), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (5, "A B C D"), (6, "word " * 3000),
       (7, "x😀y \x00 \t é"), (8, "<p>not html"), (9, "a b c d"), (None, None)]


def test_empty_tables(spark):
    none = frame(spark, [(1, "x")]).where("false")
    model = toxicity.fit(none, spark.createDataFrame([], "doc_id long, toxic int"))
    out = [exact_dedup.classify(none), substring_dedup.remove_repeats(none), suffix_dedup.remove_repeats(none), simhash_dedup.near_duplicates(none),
           secret_scan.find_secrets(spark, none, scratch_dir(spark, "led")), toxicity.score(none, model),
           language_id.predict(none, language_id.fit(none)), sentencepiece_bpe.encode(none, piece_model()),
           decontaminate.find_leaks(none, spark.createDataFrame([], "item_id long, text string")),
           html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string"))]
    assert [o.count() for o in out] == [0] * len(out)
    for keep in (exact_dedup.keep, simhash_dedup.keep_one, lambda d: toxicity.drop_toxic(d, model)):
        assert keep(none).columns == none.columns and keep(none).count() == 0


# ---- exact dedup ---------------------------------------------------------------
@pytest.mark.parametrize("settings", [{}, {"min_rows": 2, "top": 4}])
def test_exact_dedup(spark, settings):
    rows = ODD + [(100 + i, "hot text") for i in range(60)]
    got = exact_dedup.classify(frame(spark, rows), **settings).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    for r in got:
        group = next(g for t, g in by.items() if sha(t) == r.text_sha256)
        assert r.group_size == len(group) and r.keep_id == max((i for i in group if i is not None), default=None)
    kept = collections.Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(by)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    stay = exact_dedup.keep(frame(spark, rows), **settings)
    assert stay.columns == frame(spark, []).columns
    assert sorted(map(str, ((r.doc_id, r.text or "") for r in stay.collect()))) == sorted(
        str((max((i for i in g if i is not None), default=None), t)) for t, g in by.items())


# ---- substring dedup -----------------------------------------------------------
def brute_windows(rows, size):
    cut = [(i, (t or "").encode().split()) for i, t in rows]
    seen = collections.Counter(tuple(w[k:k + size]) for _, w in cut for k in range(len(w) - size + 1))
    out = []
    for i, w in cut:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k:k + size])] > 1:
                gone[k:k + size] = [True] * size
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(map(str, out))


@pytest.mark.parametrize("cells", [None, 1 << 16])
def test_substring_dedup(spark, texts, cells):
    rows = texts + [(i, t) for i, t in ODD] + [(900, "p q r " * 40), (901, "z " + " ".join(map(str, range(80)))),
                                               (902, " ".join(map(str, range(20, 60))))]
    got = substring_dedup.remove_repeats(frame(spark, rows), cells=cells).collect()
    assert sorted(str((r.doc_id, r.n_words, r.n_removed, r.kept_text)) for r in got) == brute_windows(rows, 35)


def test_substring_dedup_short_windows(spark):
    rows = [(1, "a b a b a b a"), (2, "c a b d"), (3, "d c b"), (4, "a a a a")]
    got = substring_dedup.remove_repeats(frame(spark, rows), window=3, anchor=2).collect()
    assert sorted(str((r.doc_id, r.n_words, r.n_removed, r.kept_text)) for r in got) == brute_windows(rows, 3)


# ---- suffix dedup --------------------------------------------------------------
def brute_suffixes(rows, n):
    cut = [(i, (t or "").encode()) for i, t in rows]
    low: dict = {}
    for i, b in cut:
        if i is not None:
            for k in range(len(b) - n + 1):
                low[b[k:k + n]] = min(i, low.get(b[k:k + n], i))
    out = []
    for i, b in cut:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - n + 1 if i is not None else 0):
            if low[b[k:k + n]] < i:
                gone[k:k + n] = True
        spans = int((gone[:-1] & ~gone[1:]).sum())
        out.append(str((i, len(b), int(gone.sum()), spans, bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(out)


def suffix_rows(df):
    return sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in df.collect())


@pytest.mark.parametrize("tight", [False, True])
def test_suffix_dedup(spark, texts, tight):
    rows = texts + ODD[:3] + [(3, "a b c d" * 20), (3, "a b c d" * 20), (None, "a b c d" * 20), (None, "a b c d" * 20)] + [
        (901, "é" * 60), (900, "éx" + "é" * 40), (902, "x" * 49), (903, "x" * 50), (899, "x" * 50), (904, "word " * 3000),
        (905, "q" + "word " * 30 + texts[0][1][40:140] + "z"), (-4, "😀" * 13)]
    # crowded sketches change the work, not the result
    shapes = (Shape(1 << 16, 1), Shape(1 << 16, 1, 1), Shape(1 << 16, 1), Shape(1 << 16, 1)) if tight else None
    got = suffix_dedup.remove_repeats(frame(spark, rows), shapes=shapes)
    assert suffix_rows(got) == brute_suffixes(rows, 50)


def test_suffix_dedup_memory_of_a_worker(spark):
    """The bitmaps that a worker holds, and the rows that it gets at once in the passes."""
    held = sum(s.cells * s.depth // 8 for s in suffix_dedup.shapes_for(846_000_000))
    assert held <= 140e6
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(name), "batch int"

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int32())], names=["batch"])
    with base.short_batches(spark, 1000):
        got = [r.batch for r in spark.range(0, 3500, 1, 1).mapInArrow(sizes, seen).collect()]
    assert got == [1000, 1000, 1000, 500] and spark.conf.get(name) == before


@pytest.mark.parametrize("length,digit", [(50, 24), (9, 4), (5, 2)])
def test_suffix_dedup_blocks(length, digit):
    """Blocks hold each window once; equal windows have equal keys and digests, others other digests."""
    rng = np.random.default_rng(8)
    shared = bytes(rng.integers(97, 123, 4 * length, dtype=np.uint8))
    texts = [bytes(rng.integers(97, 123, int(n), dtype=np.uint8)) + shared for n in rng.integers(0, 3 * length, 5)]
    texts += [shared[:length - 1], b"", shared[:length], b"a" * 3 * length]
    c = suffix_dedup.Chunk(texts, np.arange(len(texts)), length, digit)
    starts = [a + k for a, t in zip(c.first.tolist(), texts) for k in range(len(t) - length + 1)]
    units = np.arange(len(c.lo))
    first, last, key = c.blocks(units)
    assert sorted(x for a, b in zip(first.tolist(), last.tolist()) for x in range(a, b + 1)) == starts
    assert len(key) <= len(starts) / 2 or length < 50       # what is counted: blocks, not windows
    keys, digests, whole = {}, {}, {}
    for a, b, k in zip(first.tolist(), last.tolist(), key.tolist()):
        for x in range(a, b + 1):
            keys.setdefault(c.data[x:x + length], set()).add(k)
    for x, d in zip(starts, c.digests(np.array(starts)).tolist()):
        digests.setdefault(c.data[x:x + length], set()).add(tuple(d))
    for a, b, p, h in zip(c.lo.tolist(), c.hi.tolist(), c.place.tolist(), c.unit_hashes(units).tolist()):
        whole.setdefault((c.data[a:b + length], p - a), set()).add(h)
    assert all(len(v) == 1 for d in (keys, digests, whole) for v in d.values())
    assert len(set.union(*digests.values())) == len(digests) and len(set.union(*whole.values())) == len(whole)


def test_suffix_dedup_short_digits(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), "".join(rng.choice(list("ab"), 60))) for i in rng.permutation(60)]
    got = suffix_dedup.remove_repeats(frame(spark, rows), length=9, digit=4)
    assert suffix_rows(got) == brute_suffixes(rows, 9)


@pytest.mark.parametrize("bits", [6, 8])
def test_anchors_of_long_texts(monkeypatch, bits):
    monkeypatch.setattr(windows, "PLACE_BITS", bits)
    rng = np.random.default_rng(6)
    for n in (0, 26, 27, (1 << bits) - 1, 1 << bits, 1000, 5000):
        h = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        assert windows.anchor_places(h, 27).tolist() == [k + int(h[k:k + 27].argmin()) for k in range(n - 26)]
    # a passage far behind in a text has the digits it has in another one
    passage = bytes(rng.integers(97, 123, 400, dtype=np.uint8))
    near = suffix_dedup.Chunk([passage], np.array([1]), 50, 24)
    far = suffix_dedup.Chunk([bytes(rng.integers(97, 123, 3000, dtype=np.uint8)) + passage], np.array([2]), 50, 24)
    assert set(near.digits().tolist()) <= set(far.digits().tolist())
    words = [b"%d" % k for k in rng.integers(0, 10 ** 9, 700)]
    near, far = (substring_dedup.Chunk([b" ".join(w)], 50, 12) for w in (words[500:], words))
    assert set(near.anchor_keys().tolist()) <= set(far.anchor_keys().tolist())


# ---- SimHash -------------------------------------------------------------------
def brute_fingerprint(text):
    import xxhash
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[k:k + 4]), 42) for k in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_simhash(spark, texts):
    rows = texts + ODD
    got = simhash_dedup.near_duplicates(frame(spark, rows)).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    assert collections.Counter((r.doc_id, r.fingerprint) for r in got) == collections.Counter(
        (i, f"{f:016x}") for (i, _), f in zip(rows, fps))
    comp = brute_components(fps, 4)
    low = {c: min((i for (i, _), k in zip(rows, comp) if k == c and i is not None), default=None) for c in set(comp)}
    want = collections.Counter((f"{f:016x}", low[c]) for f, c in zip(fps, comp))
    assert collections.Counter((r.fingerprint, r.component_id) for r in got) == want


@pytest.mark.parametrize("dense", [False, True])
def test_anchors_join_every_pair(spark, dense):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 1 if dense else 40, dtype=np.uint64)
    fps = [int(b) for b in base]
    for _ in range(300):
        f = fps[rng.integers(len(fps))]
        for b in rng.choice(64, rng.integers(1, 6), replace=False):
            f ^= 1 << int(b)
        fps.append(f)
    fps = sorted(set(fps))
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in fps]
    points = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, rep long")
    got = {r.node: r.root for r in components(simhash_dedup.links(points)).collect()}
    comp = brute_components(fps, 4)
    low = {c: min(i for i, k in enumerate(comp) if k == c) for c in set(comp)}
    assert [got.get(i, i) for i in range(len(fps))] == [low[c] for c in comp]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(1, 60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100}


def test_keep_one(spark):
    rows = [(4, "a b c d e f"), (2, "a b c d e f"), (9, "other words stand here now"), (None, "a b c d e f"), (2, "a b c d e f")]
    got = simhash_dedup.keep_one(frame(spark, rows))
    assert got.columns == frame(spark, []).columns
    assert sorted((str(r.doc_id) for r in got.collect())) == ["2", "2", "9", "None"]


# ---- decontamination -----------------------------------------------------------
def brute_leaks(rows, items, limit=0.8):
    def cut(t):
        return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]

    def bag(w, k):
        return collections.Counter(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
    out = {}
    for d, t in rows:
        w = cut(t)
        for item, it in items:
            x = cut(it)
            k, size = min(5, len(x)), min(len(x), len(w))
            if not x or size < k:
                continue
            b = bag(x, k)
            for s in range(len(w) - size + 1):
                a = bag(w[s:s + size], k)
                j = sum((a & b).values()) / sum((a | b).values())
                if j >= limit:
                    n, best, at = out.get((d, item), (0, 0, 0))
                    out[d, item] = (n + 1, j, s) if j > best else (n + 1, best, at)
    return {(d, i, round(j, 9), s, n) for (d, i), (n, j, s) in out.items()}


def test_decontamination(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    long = " ".join(f"w{k}" for k in range(50))
    items = [(1, item), (2, "Short one"), (3, long), (4, None), (5, "!!"), (6, "go go go go go go go go")]
    rows = ODD + [(20, "prefix " + item.upper().replace(" ", ", ") + " suffix"), (21, item.replace("sixteen", "x")),
                  (22, "a short ONE."), (23, "clean text of other words"), (24, "y " * 40 + long.replace("w49", "q") + " z" * 9),
                  (25, "go " * 30), (26, item[:40]), (27, "x " + long + " " + long)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(frame(spark, rows), bench)
    assert {(r.doc_id, r.item_id, round(r.similarity, 9), r.start, r.n_windows) for r in got.collect()} == brute_leaks(rows, items)
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame(spark, rows), bench, max_broadcast=0).collect()} == {
        (d, i) for d, i, *_ in brute_leaks(rows, items)}
    left = decontaminate.drop_leaked(frame(spark, rows), bench)
    bad = {d for d, *_ in brute_leaks(rows, items)}
    assert left.columns == frame(spark, []).columns
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(str(i) for i, _ in rows if i not in bad)


# ---- secrets -------------------------------------------------------------------
BASE = {"assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
        "access": (r"(AKIA[A-Z0-9]+)", 20), "hex": (r"([0-9a-f]+)", 24)}


def brute_secrets(text):
    out = []
    for k, (pattern, least) in enumerate(BASE.values()):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "") if len(m[1]) >= least]
    names = list(BASE)
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secrets_and_ledger(spark, texts):
    rows = ODD + texts[:40] + [
        (30, 'é😀 password = "hunter2222" and secret=token"=abcdefgh'), (31, "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "b"),
        (32, "f" * 23 + " " + "0a" * 30 + "g" + "9" * 24), (33, "API_KEY:'abc' TOKEN: abcdefg apikey==123456"),
        (34, "token=" + "a" * 30 + " " + "secret: zzzzzz " * 200), (35, 'PASSWD"  :   \'qwerty-1.2/3')]
    path = scratch_dir(spark, "ledger")
    first = secret_scan.digest_rows(secret_scan.find_secrets(spark, frame(spark, rows[:30]), path)).collect()
    blobs = spark.read.parquet(path).count()
    got = secret_scan.digest_rows(secret_scan.find_secrets(spark, frame(spark, rows), path)).collect()
    assert spark.read.parquet(path).count() == len({t or "" for _, t in rows}) > blobs
    want = sorted(str((i, brute_secrets(t))) for i, t in rows)
    assert sorted(str((r.doc_id, r.spans)) for r in got) == want
    assert {r.spans for r in first} == {brute_secrets(t) for _, t in rows[:30]}
    for r in got:
        assert r.base_sha256 == sha(r.spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(r.spans.count(k + ":") for k in BASE)
    # a second run scans nothing; another rule version scans all again
    secret_scan.find_secrets(spark, frame(spark, rows), path).count()
    assert spark.read.parquet(path).count() == len({t or "" for _, t in rows})
    secret_scan.find_secrets(spark, frame(spark, rows), path, rule_version=2).count()
    assert spark.read.parquet(path).count() == 2 * len({t or "" for _, t in rows})


# ---- toxicity ------------------------------------------------------------------
def test_levenshtein_automaton_and_trie():
    lex = toxicity.Lexicon({"pathetic": 0.5, "worthless": 1.0, "scum": 1.0})
    assert lex.fuzzy("pathetik") == lex.fuzzy("xpathetic") == lex.fuzzy("pahetic") == 0.5
    assert lex.fuzzy("worthlesss") == 1.0 and lex.fuzzy("pathtc") == 0.0 and lex.fuzzy("scun") == 0.0

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i] + [0] * len(b) if False else _next(row, i, x, b)
        return row[-1]

    def _next(row, i, x, b):
        out = [i]
        for j, y in enumerate(b, 1):
            out.append(min(out[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        return out
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = ("".join(rng.choice(list("abc"), rng.integers(1, 8))) for _ in range(2))
        auto = toxicity.LevenshteinAutomaton(a)
        state = auto.start()
        for ch in b:
            state = auto.step(state, ch)
        assert auto.accepts(state) == (distance(a, b) <= 1)


def test_misspelled_short_terms():
    lex = toxicity.Lexicon({"idiot": 1.0, "moron": 0.5, "scum": 1.0, "ass": 1.0, "pathetic": 1.0}, frozenset(["oron"]))
    for word in ("idi0t", "diot", "idiott", "mooron", "scumm", "scm", "a55", "azs"):
        found = toxicity.all_features(f"what a {word} this is", lex)
        assert any(found[5:]) == (word != "a55") and found[:2] == [0.0, 0.0]
    assert lex.misspelled("idi0t") == (1, 1.0) and lex.misspelled("mooron") == (1, 0.5) and lex.misspelled("azs") == (2, 1.0)
    # an ordinary word near a short term is none, and a long term keeps its own sum
    assert not any(toxicity.all_features("an oron here", lex))
    assert toxicity.all_features("a pathetik day", lex)[5:] == [0.0, 0.0]


def test_misspelled_short_terms_are_predicted(spark):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(1200):
        words = [f"w{x}" for x in rng.integers(0, 400, 30)]
        if toxic := i % 4 == 0:
            words[int(rng.integers(2, 28))] = ("idiot", "moron", "scum")[i // 4 % 3]
        elif i % 4 == 1:
            words[int(rng.integers(2, 28))] = "oron"
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    model = toxicity.fit(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {"idiot", "moron", "scum"} <= model.terms.keys() and "oron" in model.known
    one = model.scorer()
    plain = " ".join(f"w{k}" for k in range(30))
    assert all(one(f"{plain} {w} {plain}") >= 0.5 for w in ("idi0t", "mooron", "scumm"))
    assert one(plain) < 0.5 and one(f"{plain} oron {plain}") < 0.5


def test_near_copies_do_not_unmake_a_term(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(1000):
        words = [f"w{x}" for x in rng.integers(0, 400, 30)]
        if i < 60:
            words[int(rng.integers(2, 28))] = "scum"
        elif i < 400:         # near copies of one toxic text
            words = [*(f"w{k}" for k in range(10)), "such", "scum", "at", "grey", "dawn", "comes", *(f"w{k}" for k in range(10)), f"n{i}"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i < 400)))
    model = toxicity.fit(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "scum" in model.terms and not {"dawn", "grey"} & model.terms.keys()
    assert model.scorer()(" ".join(f"w{k}" for k in range(20)) + " scum " + " ".join(f"w{k}" for k in range(30, 39))) >= 0.5


def test_quotation_scores_below_abuse():
    lex = toxicity.Lexicon({"moron": 1.0, "pathetic": 1.0})
    abuse, quote = toxicity.features("you are a pathetic moron", lex), toxicity.features('he wrote "moron" in the report', lex)
    assert abuse[0] > 0 and abuse[3] > 0 and abuse[2] == 0
    assert quote[0] == 0 and quote[2] > 0
    assert toxicity.features("", lex) == [0.0] * 5


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    out = QUERIES["op6_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = out.where("held_out").select("toxic", "predicted").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_first_by_hash(spark):
    from pyspark.sql import functions as F

    from inspecta.llm.base import first_by_hash
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") < 20, "b").otherwise("c").alias("g"))
    for ranges in (4, 1 << 16):
        got = first_by_hash(rows, "g", "id", 100, ranges).collect()
        assert collections.Counter(r.g for r in got) == {"a": 100, "b": 13, "c": 100}
    assert first_by_hash(rows.where("false"), "g", "id", 5).count() == 0


# ---- language ------------------------------------------------------------------
def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op7_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    rows = got.where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd(spark, docs):
    model = language_id.fit(docs)
    got = {r.doc_id: r for r in language_id.predict(frame(spark, [(1, None), (2, "12 %%% 😀"), (3, "Der und die sich")]), model).collect()}
    assert got[1].lang_pred == got[2].lang_pred == "und" and got[1].score == 0 and got[1].rejected
    assert got[3].lang_pred in {"en", "de", "fr", "es"}


# ---- SentencePiece -------------------------------------------------------------
def test_sentencepiece_equals_library(spark, texts):
    import sentencepiece as sp
    lib = sp.SentencePieceProcessor(model_file=piece_model())
    rows = ODD + texts[:80] + [(40, "  a   b "), (41, "▁x ▁"), (42, "ab" * 3000), (43, "ﬁ ½\r\n　\xa0"), (44, " "), (45, "<s></s>")]
    got = sentencepiece_bpe.encode(frame(spark, rows), piece_model()).collect()
    assert sum(r.n_corrected for r in got) == 0
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_bos=True, add_eos=True)
        want.append(str((i, ids, lib.decode(ids))))
    assert sorted(str((r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist(), r.decoded)) for r in got) == sorted(want)
    dig = sentencepiece_bpe.digest_rows(sentencepiece_bpe.encode(frame(spark, [(1, None)]), piece_model())).first()
    assert (dig.n_tokens, dig.decoded_sha256) == (2, sha(""))


def test_segments_side_by_side(texts):
    """Short segments have their agendas as rows of arrays; only others have one of their own."""
    enc = sentencepiece_bpe.Encoder(piece_model())
    words = [s for _, t in texts[:80] for s in enc.cut.findall("▁" + t.replace(" ", "▁"))]
    words = [*dict.fromkeys(words), "▁", "▁" * 9, "▁" + "a" * 31, "▁" + "a" * 32, "▁abab", "▁é漢字\n", "\U0001f600", "▁x\U0001f600y"]
    want, alone = [enc.agenda(s) for s in words], []
    one = enc.agenda
    enc.agenda = lambda s: alone.append(s) or one(s)
    out, wrong = enc.checked(words)
    assert wrong == 0 and [np.frombuffer(out[s], "<u4").tolist() for s in words] == want
    assert "▁" + "a" * 32 in alone and "▁" + "a" * 31 not in alone and len(alone) < len(words) / 2


def test_repeated_segments_are_held_once():
    import tracemalloc
    enc = sentencepiece_bpe.Encoder(piece_model())
    texts = [" ".join(["alpha", "beta", "gamma", "delta"] * 250)] * 300
    enc.encode_batch(texts[:1])
    tracemalloc.start()
    raw, wrong = enc.encode_batch(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert wrong == 0 and raw[0] == raw[-1] == struct.pack(f"<{len(raw[0]) // 4}I", *enc.lib.encode(texts[0], add_bos=True, add_eos=True))
    assert peak < 12_000_000     # 300,000 segments: 4 bytes each, and the ids


def test_texts_of_a_batch_are_not_held_at_once(spark, monkeypatch):
    """A batch of 10,000 texts is taken up in parts, and workers get few rows at once."""
    import pyarrow as pa
    import tracemalloc
    batch = pa.RecordBatch.from_arrays([pa.array(range(10_000)), pa.array(["x" * 4000] * 10_000)], names=["doc_id", "text"])
    tracemalloc.start()
    parts = [ids for ids, _ in sentencepiece_bpe._by_size(batch, 1_000_000)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(parts, []) == list(range(10_000)) and peak < 12_000_000

    model, seen = toxicity.ToxicityModel({}, [], None), []

    class Docs:
        columns, schema = ["doc_id", "text"], None

        def mapInArrow(self, run, schema):
            seen.extend(b.num_rows for b in run(iter([batch])))
    toxicity.drop_toxic(Docs(), model)
    assert sum(seen) == 10_000 and max(seen) == toxicity.ROWS
    name, used = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    for module in (sentencepiece_bpe, simhash_dedup):
        monkeypatch.setattr(module, "stored", lambda df, name_: used.append(spark.conf.get(name)) or df)
    docs, before = frame(spark, [(1, "a b")]), spark.conf.get(name)
    sentencepiece_bpe.stored_digests(docs, piece_model())
    simhash_dedup.stored_fingerprints(docs, "doc_id", "text", 4)
    assert used == [str(sentencepiece_bpe.ROWS), str(simhash_dedup.ROWS)] and spark.conf.get(name) == before


# ---- pages ---------------------------------------------------------------------
def test_pages_of_the_table(spark):
    import html
    got = QUERIES["op1_html_extract"](spark, SF_SMOKE).collect()
    raw = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMOKE}/pages.parquet").collect()}
    for r in got:
        body = re.search(r"<article>(.*?)</article>", raw[r.page_id], re.S)[1]
        cut = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?p>|</?h1>", body))
        assert r.text == "\n".join(b for b in cut if b) and r.n_chars == len(r.text)


PAGE = """<html><body><div id=top class=site-header>Site <a href=/>home</a></div><nav><ul><li><a>One</a></ul></nav>
<div class="wrap"><div class="story s{n}"><h2>Head {n} &amp; more</h2><p>First   paragraph, with <b>bold</b>&nbsp;text
<p>Second one<br>goes on<script>var x = "</p>";</script></div>
<div class="comments"><p>{comment}</p></div><aside><p>{comment}</p></aside></div>
<form><label>Mail</label></form><div class="cookie-notice">We use cookies</div><footer>bye</footer>"""


def test_host_consensus(spark):
    chat = "a reader comment " * 40
    rows = [(n, "https://www.Site.example/p%d" % n, PAGE.format(n=n, comment="short")) for n in range(9)]
    # this page's largest text stands elsewhere; the host's path finds its story
    odd = PAGE.format(n=77, comment="short").replace("<form>", f'<div class="extra"><p>{chat}</p></div><form>')
    rows += [(77, "https://www.site.example/odd", odd), (78, None, None), (79, "x", ""), (80, "x", "plain words")]
    got = {r.page_id: r.text for r in html_extract.extract(
        spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, TEXT string")).collect()}
    story = "Head {} & more\nFirst paragraph, with bold text\nSecond one goes on"
    assert all(got[n] == story.format(n) for n in (*range(9), 77))
    assert (got[78], got[79], got[80]) == ("", "", "plain words")


@pytest.mark.parametrize("tag", "svg object select template noscript iframe textarea title xmp noframes math".split())
def test_unclosed_elements_before_an_article(tag):
    article = "<article><p>The first paragraph of it.</p><p>And the last one.</p></article>"
    whole = "The first paragraph of it.\nAnd the last one."
    assert html_extract.main_text(f"<html><body><div><{tag} class=x></div>{article}</body></html>", None) == whole
    # the end tag of a later element isn't the first one's
    later = "<div><svg><title>t</title></svg></div>" if tag in ("math", "object") else f"<div><{tag}>x</{tag}></div>"
    assert html_extract.main_text(f"<html><body><div><{tag} class=x></div>{article}{later}</body></html>", None) == whole
    if tag not in ("math", "object"):
        assert html_extract.main_text(f"<div><{tag}>left out</{tag}></div>{article}", None) == whole


def test_elements_within_an_article():
    page = "<article><p>So <math><mi>a</mi><mo>=</mo><mn>1</mn></math> holds.</p><object data=x><p>A table of it.</p></object></article>"
    assert html_extract.main_text(page, None) == "So a=1 holds.\nA table of it."
    page = "<div><select><option>One<option>Two</div><article><p>The text.</p></article>"
    assert html_extract.main_text(page, None) == "The text."
    assert html_extract.main_text("<article><p>Before.</p><script>x<p>after</p></article>", None) == "Before."
    nested = "<article><p>Before.</p><svg><svg><text>a</text></svg><text>b</text></svg><p>After.</p></article>"
    assert html_extract.main_text(nested, None) == "Before.\nAfter."


@pytest.mark.parametrize("raw", ["<", "<p", "</div>x</p>y", "<!-- x", "<div " * 500, "<a href='x>y", "&am", "<p>" * 3000])
def test_broken_pages(raw):
    assert isinstance(html_extract.main_text(raw, ["div"]), str)
    html_extract.votes(raw)
