"""Operators 11 to 13 against brute force, on ordinary and odd rows."""

import hashlib
import random
import re
from collections import Counter

import pytest

from pyspark.sql import functions as F

from schemelens.llm import fill_middle, spelling, url_filter
from schemelens.llm.common import Scratch
from schemelens.llm.queries import RULES, vocabulary

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
ROWS = "doc_id long, text string, row string, n int, form string, output string"


# 11
def cut(doc_id, text):
    """(n, form, output) in plain Python."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", text
    return (n, "spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 80 else (n, "psm", f"<P>{p}<S>{s}<M>{m}")


def middle_texts():
    rng = random.Random(3)
    out = [None, "", " ", "\n\t ", "a", " a", "a ", "$1 \\2 ${x} \\E\\Q", "x <P> y", "<S>", "<M", "P> <", "<<P <", "a\u00a0b é𝄞 c",
           "\x1f a\x0b\x0cb\r\n", "(a) {3} [b] .* \\d+", "word " * 200_000, "x" * 300_000, " " * 5000 + "y" + " " * 5000]
    for _ in range(150):
        out.append("".join(rng.choice("ab <>PSM\n\té𝄞$\\") for _ in range(rng.randrange(1, 60))))
    return out


def test_fill_middle(spark):
    texts = middle_texts()
    rows = [(i, t, "r", 1, "f", "o") for i, t in enumerate(texts * 3)] + [(None, "a b c d", "r", 1, "f", "o")] * 2
    df = fill_middle.transform(spark.createDataFrame(rows, ROWS)).withColumn("parts", fill_middle.parts())
    got = df.select("row.doc_id", "row.text", "row.output", F.col("n").alias("units"), "form",
                    F.col("parts"), df.output.alias("new"), fill_middle.restore(F.col("parts")).alias("back")).collect()
    assert len(got) == len(rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r.units, r.form, r.new) == cut(r.doc_id, r.text), r.doc_id
        assert r.back == (r.text or "") and r.output == "o"
        assert (r.parts is None) == (r.form == "plain")


def test_fill_middle_empty(spark):
    assert fill_middle.transform(spark.createDataFrame([], ROWS)).count() == 0


# 12
def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(counts):
    """{word: (n, n_near, form, form_n, root)} by comparing all pairs."""
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    best = {w: min(vs, key=lambda v: (-counts[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if counts[v] >= 10 * counts[w]}
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (counts[w], len(near[w]), form.get(w), counts[form[w]] if w in form else None, root)
    return out


def grouped(df, **more):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.group_variants(df, **more).collect()}


@pytest.mark.parametrize("list_words", [128, 3])
def test_spelling(spark, list_words):
    """Also with lists so short that all are listed again, down to segments of one letter."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 8))) for _ in range(400)}
    words |= {"prefix" + "".join(rng.choice("xyz") for _ in range(rng.randrange(3, 6))) for _ in range(150)}
    long = "".join(rng.choice("abcdefgh") for _ in range(3000))
    words |= {long, long[:1500] + "z" + long[1500:], long[:-1], "q" + long, "aa", "aaa", "aaaa", "z", "𝄞ab", "𝄟ab"}
    counts = {w: 10 ** rng.randrange(5) for w in words}
    # ties in the largest count, and chains of forms
    counts |= {"tieaaaa": 1, "tiebaaa": 50, "tiecaaa": 50, "chainab": 1, "chaina": 10, "chain": 100, "chai": 1000}
    rows = [(w, n, "x") for w, n in counts.items()]
    df = spark.createDataFrame(rows, "word string, n long, near string")
    assert grouped(df, list_words=list_words) == variants(counts)


def test_spelling_odd_tables(spark):
    kind = "word string, n long"
    assert grouped(spark.createDataFrame([], kind)) == {}
    assert grouped(spark.createDataFrame([("", 3), ("a", 40)], kind)) == variants({"": 3, "a": 40})
    assert grouped(spark.createDataFrame([("ab", 1), ("ab", 2), ("ac", 30), (None, 9)], kind)) == variants(
        {"ab": 3, "ac": 30})


def test_spelling_lists_stay_short(spark):
    """A prefix that most words share is listed by later letters, and no pair is given twice."""
    rng = random.Random(6)
    words = sorted({"international" + "".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(1500)})
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    pairs = [(r.word, r.near) for r in spelling.near_pairs(df, Scratch(spark, "t"), 16).collect()]
    assert len(pairs) == len(set(map(frozenset, pairs)))
    where = {}
    for w in words:
        for i in range(13, len(w)):
            where.setdefault((i, w[:i] + w[i + 1:]), []).append(w)
    want = {frozenset((a, b)) for ws in where.values() for a in ws for b in ws if a < b}
    assert set(map(frozenset, pairs)) == want


def test_vocabulary(spark):
    import zlib
    rng = random.Random(8)
    rows = [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "", "Ärger12Straßen ABCDEFG\nabcdefg" * 3,
             " ".join(rng.choice(["Mississippi", "variant", "ÉTUDIANTE", "étudiante", "short"]) for _ in range(30))]))
            for _ in range(60)]
    want = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] += len(run) >= 7
    got = vocabulary(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.word: r.n for r in got.collect()} == {w: n for w, n in want.items() if n >= 2}


# 13
URLS = [None, "", "example.com/a", "http://", "http://EXAMPLE.com", "https://www.Example.COM/en/x?y#z", "x://com/en",
        "http://a.example.com/en/1", "http://example.com/en", "http://notexample.com/en/", "http://b.net/es/?a://b",
        "http://net/fr/", "http://c.net/fr", "http://c.net?x/es/", "//a/b", "http://u:p@d.net:80/es/", "http://1.2.3.4/x",
        "http://x.co.uk/1", "http://y.x.co.uk/2#f", "ftp://É.org/É", "http://e.net/\nes/", "http://com/", "://com/"]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match("[^?#]*", rest[len(host):]).group()


def fitting(host, path):
    best = None
    for r in RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            if best is None or len(r.host + r.path) > len(best.host + best.path):
                best = r
    return best


def test_url_rules(spark):
    rows = [(i, u, "h", "v", None) for i, u in enumerate(URLS + URLS)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string, bad string")
    got = url_filter.judge(df, RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        url = rows[r.page_id][1]
        host, path = split(url)
        rule = fitting(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text), url
        assert r.verdict == rule.verdict if rule else r.verdict in ("allow", "block")
        assert host or r.verdict == "allow"
    assert url_filter.judge(df.limit(0), RULES).count() == 0


def test_url_rules_ties(spark):
    df = spark.createDataFrame([(1, "http://b.com/ab")], "page_id long, url string")
    same = [url_filter.Rule("block", "com", "/ab"), url_filter.Rule("allow", "b.com", "/")]
    assert url_filter.judge(df, same).first().rule == "b.com/"
    with pytest.raises(ValueError):
        url_filter.judge(df, [url_filter.Rule("block", "com", "/"), url_filter.Rule("allow", "com", "/")])


def shrink(pages):
    """{host: (n, bad, share, blocked)} by loops over hosts, domains and suffixes."""
    hosts = {}
    for host, bad in pages:
        if host:
            n = hosts.setdefault(host, [0, 0])
            n[0] += bad is not None
            n[1] += bool(bad)
    place = {}
    for h in hosts:
        labels = h.split(".")
        own = re.fullmatch(r"[0-9]+(\.[0-9]+){3}", h)
        two = ".".join(labels[-2:])
        suffix = h if own else two if two in url_filter.SUFFIXES else labels[-1]
        take = 3 if suffix in url_filter.SUFFIXES else 2
        place[h] = (suffix, h if suffix == h else ".".join(labels[-take:]))
    domains, suffixes = {}, {}
    for h, (n, bad) in hosts.items():
        for table, key in ((domains, place[h][1]), (suffixes, place[h][0])):
            got = table.setdefault(key, [0, 0])
            got[0] += n
            got[1] += bad
    home = {d: s for s, d in place.values()}

    def weight(children, parent_of):
        groups = {}
        for c, (n, bad) in children.items():
            if n:
                groups.setdefault(parent_of(c), []).append((n, bad))
        over = room = 0
        for g in groups.values():
            total = sum(n for n, _ in g)
            p = sum(b for _, b in g) / total
            v = p * (1 - p)
            over += sum(n * (b / n - p) ** 2 for n, b in g) - v * (len(g) - 1)
            room += v * (total - sum(n * n for n, _ in g) / total - (len(g) - 1))
        return min(max(room / over - 1, 2), 1000) if room > 1e-9 and over > 1e-9 else 1000

    w = [weight(hosts, lambda h: place[h][1]), weight(domains, home.get), weight(suffixes, lambda s: None)]
    total = [sum(x[i] for x in suffixes.values()) for i in (0, 1)]
    centre, known = (total[1] + 0.5) / (total[0] + 1), total[0] + 1
    post = lambda x, m, k, w: ((x[1] + m * min(w, k)) / (x[0] + min(w, k)), x[0] + min(w, k))
    out = {}
    for h, x in hosts.items():
        at = post(suffixes[place[h][0]], centre, known, w[2])
        at = post(domains[place[h][1]], *at, w[1])
        share, k = post(x, *at, w[0])
        out[h] = (*x, share, share - 1.645 * (share * (1 - share) / (k + 1)) ** 0.5 > 0.5)
    return out


def test_host_reputation(spark):
    rng = random.Random(7)
    rates = {"good.com": 0.02, "a.good.com": 0.05, "bad.com": 0.95, "x.bad.com": 0.9, "mixed.org": 0.3, "spam.biz": 0.99,
             "new.spam.biz": None, "b.spam.biz": None, "shop.co.uk": 0.9, "www.shop.co.uk": None, "other.co.uk": 0.1,
             "10.0.0.1": 0.8, "localhost": 0.2}
    pages = [(h, None if r is None or rng.random() < 0.3 else rng.random() < r)
             for h, r in rates.items() for _ in range(rng.randrange(3, 120))] + [("", True)] * 5
    got = {r.host: r for r in url_filter.reputation(spark.createDataFrame(pages, "host string, bad boolean")).collect()}
    want = shrink(pages)
    assert set(got) == set(want)
    for h, (n, bad, share, blocked) in want.items():
        assert (got[h].n, got[h].bad, got[h].blocked) == (n, bad, blocked), h
        assert abs(got[h].share - share) < 1e-9
    assert {h for h in got if got[h].blocked} >= {"bad.com", "spam.biz", "new.spam.biz"}
    assert not {h for h in got if got[h].blocked} & {"good.com", "mixed.org", "other.co.uk", "localhost"}


# 3, changed in this round
def test_packing_words_survive_a_small_memory():
    """Parts forgotten and learned again, odd words and white space of all kinds give the tokenizer's own ids."""
    import numpy as np
    import pyarrow as pa
    import public_tokenizers
    from schemelens.llm.packing import WordTokens
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(2)
    texts = [None, "", " \t\x0b\x0c\r\n", "a\x1cb\x85c d e", "don't DON'T 3.14", "<|endoftext|> x<|startoftext|>", "É𝄞ß İ ǅ ×÷"]
    texts += [" ".join("".join(rng.choice("abcXYZé.,'1") for _ in range(rng.randrange(1, 9))) for _ in range(300))
              for _ in range(40)]
    own = WordTokens(path, memory=20_000)
    tok = Tokenizer.from_file(path)
    for again in range(2):
        for at in range(0, len(texts), 5):
            for t, ids in zip(texts[at:at + 5], own.ids(pa.array(texts, pa.string()).slice(at, 5))):
                assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t or "", add_special_tokens=False).ids, t


def test_packing_raises_the_window_count(monkeypatch):
    """Where cuts at the edges may not help, windows are added until all fit."""
    from schemelens.llm import packing
    monkeypatch.setattr(packing, "ROUNDS", 0)
    for sizes in ([2100] * 40, [3000, 3000, 2000], [513] * 7):
        parts, k = packing.cut_block(sizes, 4096)
        load = Counter()
        for own, size in zip(parts, sizes):
            assert sum(n for _, n in own) == size
            for w, n in own:
                load[w] += n
        assert max(load.values()) <= 4096 and max(load) < k
        assert -(-sum(sizes) // 4096) <= k <= -(-sum(sizes) // 4096) + 4


def test_quality_rules_reject_a_host_and_take_any_column_name(spark):
    """A host whose documents mostly fail is rejected with its good ones; columns may have the names used inside."""
    from schemelens.llm import quality_rules as Q
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, "bad" if i < 60 else f"host{i % 9}", good if i >= 60 or i % 20 == 0 else "too short", i, i) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, _bad_host long, _Bad_Host_ long")
    got = Q.filter_documents(df)
    assert got.columns == df.columns
    kept = {r.doc_id for r in got.collect()}
    assert kept == set(range(60, 300)) == {r.doc_id for r in Q.judge(df).where("kept").collect()}
    verdicts = {r.host: r.rejected for r in Q.hosts(Q.measure(df)).collect()}
    assert verdicts.pop("bad") and not any(verdicts.values())
