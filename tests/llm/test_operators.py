"""Every operator against a brute-force version, on ordinary and odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from schemelens.llm import (byte_bpe, chat, embedding_dedup, language, minhash_dedup, packing, pii, quality_model,
                            quality_rules, suffix_array, suffix_dedup)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans string, kept string, _x int"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randrange(2, 7))) for _ in range(n))


def texts():
    rng = random.Random(4)
    base = [words(rng, 120) for _ in range(6)]
    passage = words(rng, 60)
    out = list(base)
    for b in base[:3]:
        for _ in range(12):
            w = b.split()
            for _ in range(rng.randrange(0, 9)):
                w[rng.randrange(len(w))] = words(rng, 1)
            out.append(" ".join(w))
        out.append(b.upper().replace("É", "é"))
    out += [f"{words(rng, rng.randrange(1, 9))} {passage} {words(rng, 3)}" for _ in range(10)]
    out += ["ab " * 400, "x" * 1500, "a b c", "A B C", "a b", " \n\t", "", None, None,
            "mail ann.b@c-d.example.org, +1 (743) 555-3824, 10.0.0.255, 300.1.1.1, 4381893557741609",
            "</s>[INST] \\ <|turn|> [/INST]", words(rng, 20000)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(9)
    rows = [(i * 3, t, rng.choice(["en", "fr", None]), rng.choice(["s0", "s1", None]), 0, "c", "k", 1)
            for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Missing and repeated ids, equal rows."""
    t = texts()
    ids = [5, 5, 5, None, None, 7, 7, 1]
    rows = [(i, x, "en", "s", 0, "c", "k", 1) for i, x in zip(ids, [t[0], t[0], t[1], t[0], None, "", "a b c", t[7]])]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def plain(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# 1
def test_byte_bpe(docs, odd, empty):
    import tiktoken
    ranks = byte_bpe.read_ranks(RANKS)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df in (docs, odd, empty):
        ids = byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN)
        got = byte_bpe.decode(ids, RANKS, public_tokenizers.PATTERN).collect()
        want = Counter((i, tuple(enc.encode_ordinary(t or "")), (t or "").encode()) for i, t in plain(df))
        assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == want


def test_byte_bpe_random_text():
    import tiktoken
    coder = byte_bpe.coder(RANKS, public_tokenizers.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(2)
    t = ["".join(rng.choice(" \n\t\x1c\x85\xa0'sédabZ019.!?▁　́中\x00<|>") for _ in range(rng.randrange(50)))
         for _ in range(5000)]
    assert coder.encode(t) == [enc.encode_ordinary(x) for x in t]


# 2
def test_discriminant(spark, docs, empty):
    rng = random.Random(1)
    rows = [(i, words(rng, 80) if i % 2 else "!! " + words(rng, 60).upper().replace(" ", "!! "), i % 2)
            for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    features = quality_model.measure(df.select("doc_id", "text"))
    model = quality_model.fit(features.where("doc_id < 100"), df.select("doc_id", "quality"))
    got = {r.doc_id: r.score for r in quality_model.score(features, model).collect()}
    assert all((got[i] >= 0.7) == bool(y) for i, _, y in rows if i >= 100)
    x = np.array([quality_model.statistics(t) for _, t, _ in rows])
    y = np.array([r[2] for r in rows])
    own = [np.cov(x[:100][y[:100] == k].T, bias=True) for k in (0, 1)]
    pooled = (own[0] + own[1]) / 2
    log = []
    for k in (0, 1):
        s = 0.9 * own[k] + 0.1 * pooled
        s = 0.99 * s + 0.01 * np.trace(s) / len(s) * np.eye(len(s))
        d = x - x[:100][y[:100] == k].mean(0)
        log.append(-0.5 * (np.linalg.slogdet(s)[1] + (d @ np.linalg.inv(s) * d).sum(1)))
    want = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
    assert np.allclose([got[i] for i in range(200)], want, atol=1e-6)
    scored = quality_model.score(quality_model.measure(docs), model).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert quality_model.score(quality_model.measure(empty), model).count() == 0
    none = quality_model.fit(features, df.where("false").select("doc_id", "quality"))
    one = quality_model.fit(features, df.where("quality = 1").select("doc_id", "quality"))
    assert none.prior == (0.5, 0.5) and one.prior == (0.0, 1.0)


# 3
def test_packing(docs, odd, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORDS)
    for df in (docs, odd, empty):
        pieces = packing.pack(df, WORDS).collect()
        want = Counter()
        for i, t in plain(df):
            want[(i, np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes())] += 1
        whole, seqs = Counter(), defaultdict(list)
        rest = defaultdict(list)
        for p in pieces:
            assert len(p.ids) == 4 * p.length
            seqs[p.sequence_id].append((p.offset, p.length))
            rest[(p.doc_id, p.doc_tokens)].append((p.start, bytes(p.ids)))
        for own in seqs.values():
            at = 0
            for off, n in sorted(own):
                assert off == at
                at += n
            assert at <= 4096
        if df is docs:
            for (i, n), own in rest.items():
                ids = b"".join(b for _, b in sorted(own))
                assert len(ids) == 4 * n
                whole[(i, ids)] += 1
            assert whole == want
        else:
            assert sum(p.length for p in pieces) == sum(len(b) // 4 * c for (_, b), c in want.items())


def test_differencing_is_near_equal():
    rng = random.Random(3)
    sizes = [1 + int(rng.expovariate(1 / 800)) % 4000 for _ in range(900)]
    window, k = packing.pack_block(sizes, 4096)
    loads = Counter()
    for s, w in zip(sizes, window):
        loads[w] += s
    assert max(loads.values()) <= 4096 and k * 4096 < 1.02 * sum(sizes)
    assert packing.pack_block([4096, 4096, 1], 4096)[1] == 3 and packing.pack_block([], 4096) == ([], 0)
    assert packing.pack_block([3000, 3000, 2000], 4096)[1] == 3  # two windows would hold the sum but not the pieces


@pytest.mark.parametrize("sizes", [[2100] * 998, [1400] * 700, [3000, 3000, 2000], [4095] * 50, [2049, 4000, 9] * 99,
                                   [4096, 4096, 1], [5], []])
def test_rests_are_cut_before_windows_stay_empty(sizes):
    """No block pads a whole window, and every token is in one piece."""
    ids = [np.arange(n, dtype="<u4").tobytes() for n in sizes]
    block = packing._Block(4096)
    for i, x in enumerate(ids):
        block.add(i, x)
    out, end = block.pieces(0)
    assert end == -(-sum(sizes) // 4096)
    got, filled = defaultdict(list), defaultdict(list)
    for doc, start, n, total, seq, offset, x in out:
        assert len(x) == 4 * n > 0 and total == sizes[doc]
        got[doc].append((start, x))
        filled[seq].append((offset, n))
    assert all(b"".join(x for _, x in sorted(got[i])) == whole for i, whole in enumerate(ids))
    for own in filled.values():
        own.sort()
        assert all(a + n == b for (a, n), (b, _) in zip([(0, 0)] + own, own)) and sum(own[-1]) <= 4096


# 4
def shingles(t):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return set(zip(w, w[1:], w[2:], w[3:])) if len(w) >= 4 else {tuple(w)} if w else set()


def component_of(keys, linked):
    low = {k: k for k in keys}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def test_minhash(docs, empty):
    sets = {i: shingles(t) for i, t in plain(docs)}
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a]
              and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    low = component_of(sets, linked)
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(docs).collect()}
    assert {i: (len(sets[i]), low[i], low[i] == i) for i in sets} == {
        i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()}
    assert len(set(low.values())) < len(sets) - 20
    left = minhash_dedup.deduplicate(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == set(low.values())
    assert minhash_dedup.near_duplicates(empty).count() == 0


def test_minhash_links_that_miss_the_centre(spark):
    """A chain of texts, each a link to the next only, and a crowd of unlinked relatives around one base."""
    rng = random.Random(8)
    base = words(rng, 150).split()
    rows, w = [], list(base)
    for i in range(25):
        rows.append(" ".join(w))
        for _ in range(3):
            w[rng.randrange(len(w))] = words(rng, 1)
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(4, 9)):
            w[rng.randrange(len(w))] = words(rng, 1)
        rows.append(" ".join(w))
    rng.shuffle(rows)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    sets = {i: shingles(t) for i, t in enumerate(rows)}
    low = component_of(sets, [(a, b) for a in sets for b in sets
                              if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    assert {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(df).collect()} == low


def test_minhash_odd_ids(odd):
    got = Counter((r.doc_id, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(odd).collect())
    # the copies of id 5 and of the missing id are one component, kept once; empty texts stand alone
    assert sum(got.values()) == 8 and got[(5, 5, True)] == 2 and got[(5, 5, False)] == 1
    assert got[(None, 5, False)] == 1 and got[(None, None, True)] == 1
    assert got[(7, 7, True)] == 2
    assert minhash_dedup.deduplicate(odd).count() == 6


def test_minhash_other_thresholds(spark):
    """Pairs just above 60 percent are linked at that threshold; bands and bound at 80 percent are the tuned ones."""
    assert minhash_dedup.tuned(80) == (80, 48, 6, 0.68)
    rng = random.Random(21)
    rows = []
    for i in range(40):
        w = words(rng, 150).split()
        rows.append(" ".join(w))
        for k in range(8 + i % 3):
            w[7 + 15 * k % 150] = words(rng, 2).replace(" ", "")
        rows.append(" ".join(w))
    sets = {i: shingles(t) for i, t in enumerate(rows)}
    linked = [(a, b) for a in sets for b in sets
              if a < b and 100 * len(sets[a] & sets[b]) >= 60 * len(sets[a] | sets[b])]
    assert sum(100 * len(sets[a] & sets[b]) < 66 * len(sets[a] | sets[b]) for a, b in linked) > 10
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(df, percent=60).collect()}
    assert got == component_of(sets, linked)
    with pytest.raises(ValueError):
        minhash_dedup.tuned(4)


@pytest.mark.parametrize("top", [2**60, 2**63 - 10])
def test_large_repeated_and_missing_ids(spark, top):
    """Ids too large for a double, one of them repeated, one missing, some negative."""
    rng = random.Random(2)
    a, b, c, d = (words(rng, 60) for _ in range(4))
    rows = [(top + 1, a), (top + 3, a), (top + 5, b), (top + 5, c), (None, b), (None, d), (-top + 1, c), (-top + 3, d),
            (-top + 3, d), (7, words(rng, 60)), (None, words(rng, 60))]
    component = {a: top + 1, b: top + 5, c: -top + 1, d: -top + 3}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash_dedup.near_duplicates(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = got.collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((i, component.get(t, i)) for i, t in rows)
    assert sum(r.kept for r in got) == len({t for _, t in rows})
    assert Counter(r.text for r in minhash_dedup.deduplicate(df).collect()) == Counter({t for _, t in rows})
    unit = {t: [float(x == i) for x in range(9)] for i, t in enumerate(dict.fromkeys(t for _, t in rows))}
    vectors = spark.createDataFrame([(i, unit[t]) for i, t in rows], "vec_id long, embedding array<double>")
    got = embedding_dedup.near_duplicates(vectors).collect()
    assert Counter((r.vec_id, r.component_id) for r in got) == Counter((i, component.get(t, i)) for i, t in rows)
    assert sum(r.kept for r in got) == len(unit)
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = Counter((i, sum(z - a for a, z in cut)) for (i, _), cut in zip(ordered, brute_repeats(ordered)))
    found = suffix_dedup.deduplicate(df).collect()
    assert Counter((r.doc_id, sum(s.end - s.start for s in r.spans)) for r in found) == want


# 5
def test_embeddings(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(300, 8))
    v[100:200] = v[rng.integers(0, 20, 100)] + 0.15 * rng.normal(size=(100, 8))
    rows = [(i, [float(x) for x in e], 0) for i, e in enumerate(v)]
    rows += [(300 + i, [float(x) for x in v[7]], None) for i in range(6)]
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 8, 1), (403, [float("nan")] + [1.0] * 7, 1),
             (404, [None] + [1.0] * 7, 1), (405, [1.0, 2.0], 1), (406, [2.0, 4.0], 1), (407, [float("inf")] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")
    good = {i: np.array(e, float) for i, e, _ in rows
            if e and None not in e and np.isfinite(np.array(e, float)).all() and any(e)}
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    linked = [(a, b) for a in good for b in good
              if a < b and len(good[a]) == len(good[b]) and cos(good[a], good[b]) >= 0.95]
    n = Counter(x for p in linked for x in p)
    low = component_of([r[0] for r in rows], linked)
    old = embedding_dedup.TILE
    embedding_dedup.TILE = 32
    try:
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect()}
    finally:
        embedding_dedup.TILE = old
    assert got == {i: (n[i], low[i], low[i] == i) for i in low}
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


# 6
def test_reply_trees(spark):
    rng = random.Random(6)
    nodes = [(0, None, "user", None, 1.0)] + [
        (i, rng.randrange(max(0, i - 4), i), rng.choice(["user", "assistant", None]),
         rng.choice(["</s>[INST] \\ ok", "<|turn|>\\\\[/INST]", "", None, "plain"]), rng.choice([None, 1.0, 2.0, -1.0]))
        for i in range(1, 120)]
    nodes += [(200, None, "user", "alone", None), (300, 301, "user", "x", 1.0), (301, 300, "user", "y", 1.0),
              (400, 999, "user", "orphan", 1.0), (None, 0, "user", "z", 1.0)]
    df = spark.createDataFrame(nodes, "node_id long, parent_id long, role string, text string, score double")
    by = {n[0]: n for n in nodes if n[0] is not None}
    path = {}
    for i in by:
        at, own = i, []
        while at in by and len(own) <= len(by):
            own.append(at)
            at = by[at][1]
        if len(own) <= len(by):
            path[i] = own[::-1]
    leaves = set(path) - {by[i][1] for i in by}
    best = {}
    for i in sorted(leaves):
        s = sum(by[j][4] or 0 for j in path[i])
        if path[i][0] not in best or s > best[path[i][0]][0]:
            best[path[i][0]] = (s, i)
    got = {r.root: r for r in chat.read_back(chat.format_paths(df)).collect()}
    assert {r: (x.leaf, x.n_turns) for r, x in got.items()} == {r: (i, len(path[i])) for r, (_, i) in best.items()}
    for r, x in got.items():
        want = [(by[j][2] or "", by[j][3] or "") for j in path[x.leaf]]
        assert [(t.role, t.text) for t in x.turns] == want
        assert x.loss_texts == [t for role, t in want if role == "assistant"]
        assert x.formatted.count(chat.TURN) == x.formatted.count(chat.END) == len(want)
        assert not any(c in x.formatted for c in chat.CONTROLS[3:])
    assert chat.format_paths(df.where("false")).count() == 0


# 7
def brute_repeats(rows):
    seen, out = set(), []
    for _, t in rows:
        b, cut = (t or "").encode(), []
        for s in range(len(b) - 99):
            w = b[s:s + 100]
            if w not in seen:
                seen.add(w)
            elif cut and s <= cut[-1][1]:
                cut[-1][1] = s + 100
            else:
                cut.append([s, s + 100])
        out.append([tuple(c) for c in cut])
    return out


@pytest.mark.parametrize("per_shard", [1024, 3])
def test_suffix_dedup(docs, empty, per_shard, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_VARIANTS", per_shard)
    rows = sorted(plain(docs))
    want = brute_repeats(rows)
    got = {r.doc_id: r for r in suffix_dedup.deduplicate(docs).collect()}
    assert [[(s.start, s.end) for s in got[i].spans] for i, _ in rows] == want and any(want)
    for (i, t), cut in zip(rows, want):
        b = (t or "").encode()
        inside = {x for a, z in cut for x in range(a, z)}
        assert bytes(got[i].kept) == bytes(c for x, c in enumerate(b) if x not in inside)
    cleaned = suffix_dedup.remove_repeats(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    assert suffix_dedup.deduplicate(empty).count() == 0


def test_suffix_dedup_odd_ids(odd):
    got = Counter((r.doc_id, bytes(r.kept) == b"") for r in suffix_dedup.deduplicate(odd).collect())
    # of the equal rows with id 5 one keeps its text; the row without an id comes after them
    assert got == {(5, False): 2, (5, True): 1, (None, True): 2, (7, True): 1, (7, False): 1, (1, False): 1}


@pytest.mark.parametrize("induce", ["_induce_blocks", "_induce_steps"])
def test_induced_sorting(induce, monkeypatch):
    one = getattr(suffix_array, induce)
    monkeypatch.setattr(suffix_array, "_induce_blocks", one)
    monkeypatch.setattr(suffix_array, "_induce_steps", one)
    rng = random.Random(7)
    for _ in range(300):
        k = rng.choice([2, 3, 30])
        t = [rng.randrange(1, k + 1) for _ in range(rng.randrange(60))] + [0]
        sa = suffix_array.suffix_array(np.array(t), k + 1)
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        shared = suffix_array.permuted_lcp(np.array(t), sa, 16)
        for a, b in zip(sa[:-1], sa[1:]):
            n = 0
            while max(a, b) + n < len(t) and t[a + n] == t[b + n] and n < 16:
                n += 1
            assert shared[b] == n


# 8
def test_rules(docs, odd, empty):
    for df in (docs, odd):
        got = Counter((r.doc_id, *(r[c] for c in quality_rules.COUNTS), r.base_failed)
                      for r in quality_rules.judge(df).collect())
        want = Counter()
        for i, t in plain(df):
            w = re.findall("[^\x20\x09-\x0d]+", t or "")
            lines = [x for x in (t or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
            n = Counter(zip(w, w[1:], w[2:]))
            inside = {j + k for j in range(len(w) - 2) if n[tuple(w[j:j + 3])] > 1 for k in range(3)}
            want[(i, len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t or "")), len(lines) - len(set(lines)),
                  len(lines), len(inside), len(w) < 50 or 2 * len(inside) > len(w))] += 1
        assert got == want
    assert quality_rules.judge(empty).count() == 0


def test_host_verdict(spark):
    rng = random.Random(10)
    good = [(i, words(rng, 60), f"h{i % 5}") for i in range(100)]
    bad = [(100 + i, "short" if i % 4 else words(rng, 60), "farm") for i in range(40)]
    single = [(200, "short", "tiny"), (201, words(rng, 60), "tiny"), (202, words(rng, 60), None)]
    df = spark.createDataFrame(good + bad + single, "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality_rules.judge(df).where("kept").collect()}
    assert kept == {i for i in range(100)} | {201, 202}
    filtered = quality_rules.filter_documents(df)
    assert filtered.columns == df.columns and {r.doc_id for r in filtered.collect()} == kept


# 9
def brute_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_pii(docs, empty):
    rng = random.Random(11)
    for _ in range(20000):
        t = "".join(rng.choice("012594.+-@() ab4é") for _ in range(rng.randrange(60)))
        assert [s for s in pii.find(t) if s[0] in pii.KINDS[:4]] == brute_spans(t)
    t = "See https://ann:pw@host/x, IBAN DE89 3704 0044 0532 0130 00, account no. 12345678 token = \"abcdefghij0123456789\""
    assert [(k, t[a:b]) for k, a, b in pii.find(t)] == [
        ("url", "https://ann:pw@host/x,"), ("account", "12345678"), ("iban", "DE89 3704 0044 0532 0130 00"),
        ("secret", "abcdefghij0123456789")]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.detect(docs).collect()}
    assert got == {i: pii.find(t or "") for i, t in plain(docs)}
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    assert {r.text for r in clean.where("text like 'mail%'").collect()} == {"mail <EMAIL>, <PHONE>, <IP>, 300.1.1.1, <CARD>"}
    assert pii.redact(empty).count() == pii.detect(empty).count() == 0


# 10
def test_language(spark, docs, empty):
    source = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = language.learn(source.where("doc_id % 3 <> 1"))
    rows = source.where("doc_id % 3 <> 1").select("lang", "text").collect()
    n = defaultdict(Counter)
    for r in rows:
        s = " " + re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in r.text.lower())).strip() + " "
        n[r.lang].update(s[i:i + k] for k in (1, 2, 3) for i in range(len(s) - k + 1) if " " not in s[i:i + k][1:k - 1]
                         and s[i:i + k] != " ")
    number = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    for lang, count in n.items():
        want = sorted(((-c, number(g)) for g, c in count.items()))[:language.PROFILE]
        assert learned[lang] == [g for _, g in want]
    held = source.where("doc_id % 3 = 1")
    got = language.predict(held, learned).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)
    out = {r.doc_id: r for r in language.predict(docs, learned).collect()}
    for i, t in plain(docs):
        assert (out[i].lang_pred == "und") == (not any(c.isalpha() for c in t or "")) and 0 <= out[i].score <= 1
    assert language.learn(empty) == {}
    assert {r.lang_pred for r in language.predict(docs, {}).collect()} == {"und"}


def test_digests_are_of_the_real_output(spark):
    from schemelens.llm import queries
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op1_byte_bpe(spark, sf).collect():
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest()
    tok = packing.word_tokens(WORDS)
    for r in queries.op3_packing(spark, sf).collect():
        ids = tok.ids([rows[r.doc_id]])[0] + b"\2\0\0\0"
        assert r.ids_crc32 == zlib.crc32(ids[4 * r.start:4 * (r.start + r.length)])
