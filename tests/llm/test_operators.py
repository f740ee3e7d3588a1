"""The ten operators against brute force on small tables: nulls, empty and long texts, ties, repeats, extra columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loamline.llm import decontaminate, fingerprint, lang_id, line_dedup, mixing, ngram_join, secrets, simple8b, token_output, toxicity, url_filter
from loamline.llm.common import new_path
from loamline.llm.queries import tokenizer_json

R = random.Random(4)
WORDS = ["alpha", "beta", "Gamma", "delta", "épée", "zeta", "eta", "theta", "iota", "kappa", "Éa", "mu"]
DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, size int"


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


BASE = prose(120, 1)
PASSAGE = prose(14, 2)


def edits(text, k, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(k):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


TEXTS = [
    None, "", "   \n ", "one", "one two", "One TWO", BASE, BASE, edits(BASE, 1, 1), edits(BASE, 2, 2), edits(BASE, 6, 3), edits(BASE, 1, 4),
    prose(60, 5) + " " + PASSAGE + " " + prose(10, 6), PASSAGE, PASSAGE + "\n" + PASSAGE, prose(6000, 7), prose(300, 8),
    "token = abcdefghijkl, AKIA" + "B" * 16 + " token: password: abcdefghijklmn deadbeefdeadbeef0", 'é PASSWORD="0123456789abcdef" API_KEY=short api_key=longenough123',
    "tab\tseparated  double  spaces\n\n indented", "<|endoftext|> it's we'll", "ab cd ef gh ij kl mn", "ab cd ef gh ij kl mx", "a\nb\na\nb",
]


def rows():
    out = [(i, t, "en", None if i % 5 == 0 else f"s{i % 4}", 1, 0.5, "x", 3) for i, t in enumerate(TEXTS)]
    return [*out, out[6], out[0], (None, "no id here", "en", "s1", 1, 0.5, "x", 3), (50, edits(BASE, 3, 9), "de", "s9", 1, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOC).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def test_simple8b_round_trip():
    g = np.random.default_rng(1)
    for k in range(60):
        n = int(g.integers(0, 4000))
        ids = g.integers(0, 1 << int(g.integers(1, 62)), n, dtype=np.uint64)
        ids[: n // 9] = np.uint64(2**64 - 1) if k % 3 else np.uint64(0)
        g.shuffle(ids)
        words, offsets = simple8b.encode(ids)
        assert (simple8b.decode(words, offsets, n) == ids).all()


def test_chunks_encode_as_whole_texts():
    from tokenizers import Tokenizer

    encode, whole = token_output.chunk_encoder(tokenizer_json()), Tokenizer.from_str(tokenizer_json())
    odd = ["".join(R.choice("ab \n\t.'é1\x1c") for _ in range(R.randrange(14))) for _ in range(500)]
    texts = [t or "" for t in TEXTS] + odd
    for some in (texts, texts[7:], ["a", "b c"], [""], [" ", "x  y"], []):
        ids, counts = encode(pa.array(some, pa.string()))
        for t, own in zip(some, np.split(ids, np.cumsum(counts))[:-1], strict=True):
            assert whole.encode(t, add_special_tokens=False).ids == own.tolist(), repr(t)


def test_memo_forgets_and_stays_right(monkeypatch):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(tokenizer_json())
    monkeypatch.setattr(token_output, "MEMO_BYTES", 3000)
    memo = token_output.Memo(whole, False)
    for k in range(40):
        names = sorted({prose(1, j) for j in range(k, k + 30)}) + ["", " é", " a<|endoftext|>", " \U0001f600", " \n x", " z "][: k % 7]
        ids, counts = memo.gathered(np.arange(len(names))[::-1], names)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts))[:-1]] == [whole.encode(n, add_special_tokens=False).ids for n in names[::-1]]
        assert memo.size <= 3000 + 40 * 300 and set(memo.known) >= set(names)


def test_token_file(spark, docs, empty):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(tokenizer_json())
    path = new_path(spark, "t")
    token_output.write_tokens(docs, path, tokenizer_json())
    found = sorted(token_output.read_digests(spark, path).collect(), key=lambda r: r.start)
    want, start = [], 0
    for r in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*whole.encode(r[1] or "", add_special_tokens=False).ids, 2]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in found] == want
    path = new_path(spark, "t")
    token_output.write_tokens(empty, path, tokenizer_json())
    assert token_output.read_digests(spark, path).count() == 0


def test_mixing(spark, docs, empty):
    found = mixing.in_order(mixing.plan(docs)).collect()
    assert len(found) == len(rows())
    sizes = Counter()
    for r in rows():
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(names, mixing.targets([sizes[s] for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))], 1.5 * sum(sizes.values()), 2.0), strict=True))
    taken = Counter()
    for r in found:
        assert r.taken <= 2 * r.size and r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    for s in names:
        assert abs(taken[s] - want[s]) <= 1
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    places = [r.position for r in found if r.position is not None]
    assert all(0 <= p <= 1 for p in places)
    assert sorted((r.doc_id or -1, r.taken, r.position or -1) for r in found) == sorted((r.doc_id or -1, r.taken, r.position or -1) for r in mixing.in_order(mixing.plan(docs)).collect())
    assert mixing.in_order(mixing.plan(empty)).count() == 0
    drawn = mixing.draw(docs)
    assert drawn.columns == docs.columns and drawn.count() > 0


def test_mixing_keeps_the_other_columns_of_repeated_rows(spark):
    one = Counter({("a", 1): 1, ("b", 2): 1, (None, 3): 1, ("c", 4): 2})
    data = [(7, "some five words in here", "s", *k) for k, n in one.items() for _ in range(n)] + [(None, "no id", "s", "x", 1), (None, "no id", "s", "y", 2)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, lang string, n_chars long").repartition(3)
    twice, once = (mixing.draw(docs, mixing.Curriculum(share=x)) for x in (2.0, 1.0))
    count = lambda d: Counter((r.doc_id, r.text, r.source, r.lang, r.n_chars) for r in d.collect())
    assert count(twice) == Counter({r: 2 * n for r, n in Counter(data).items()})
    assert count(once) == Counter(data)
    some = mixing.draw(docs, mixing.Curriculum(share=0.5))
    assert sum(count(some).values()) == sum(len(r.draws) for r in mixing.plan(docs, mixing.Curriculum(share=0.5), whole=True).collect())


def test_position_inverts_the_schedule(spark):
    knots = [(0.0, 0.5, 0.4, 1.2, 0.0), (0.5, 1.0, 1.2, 1.2, 0.4)]
    d = spark.createDataFrame([(f / 20, knots) for f in range(21)], "f double, k array<struct<a:double,b:double,v:double,w:double,done:double>>")
    for r in d.select("f", mixing.position(F.col("f"), F.col("k")).alias("t")).collect():
        a, b, v, w, done = next(x for x in reversed(knots) if x[4] <= r.f)
        assert done + (r.t - a) * v + (w - v) / (b - a) * (r.t - a) ** 2 / 2 == pytest.approx(r.f)


def spans_of(text):
    out = []
    for k, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text):
            if len(m.group(rule.group)) >= rule.least:
                out.append((m.start(), k, m.end(), rule.kind))
    return [(kind, a, b) for a, _, b, kind in sorted(out)]


def test_secrets(spark, docs, empty):
    found = secrets.scan(docs).collect()
    assert len(found) == len(rows())
    for r in found:
        assert [(s.kind, s.start, s.end) for s in r.spans] == spans_of(r.text or "")
    assert secrets.scan(empty).count() == 0
    many = "x ".join(f"token=abcdefghijkl{k} " for k in range(3000))
    (r,) = secrets.scan(spark.createDataFrame([(1, many)], "doc_id long, text string")).collect()
    assert [(s.kind, s.start, s.end) for s in r.spans] == spans_of(many)
    assert secrets.query(secrets.BASE[2]) == [] and secrets.trigrams("AKIA") == ["aki", "kia"]


def test_queries_are_derived_from_expressions():
    held = {
        "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"), "access": ("AKIA",), "hex": (), "google": ("AIza",), "jwt": ("eyJ.eyJ",),
        "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "slack": ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"),
    }
    by = {r.kind: secrets.query(r) for r in secrets.RULES}
    for kind, words in held.items():
        if kind == "jwt":
            assert by[kind] == [[".ey", "eyj"]]
        else:
            assert by[kind] == sorted(secrets.trigrams(w) for w in words), kind
    assert by["private_key"] == [sorted({*secrets.trigrams("-----BEGIN "), *secrets.trigrams("PRIVATE KEY-----")})]
    r = random.Random(9)
    part = lambda: r.choice(["abc", "[xy]z", "(?:foo|ba?r)", "q{2,3}", "w*", "[a-z]", "Den", "(k|lm)+", ".", "[^a]b"])
    made = {"abc": ["abc"], "[xy]z": ["xz", "yz"], "(?:foo|ba?r)": ["foo", "bar", "br"], "q{2,3}": ["qq", "qqq"], "w*": ["", "ww"], "[a-z]": ["m"], "Den": ["Den"], "(k|lm)+": ["k", "lmk"], ".": ["-"], "[^a]b": ["cb"]}
    for _ in range(300):
        parts = [part() for _ in range(r.randrange(1, 5))]
        text = "".join(r.choice(made[p]) for p in parts)
        assert re.fullmatch("".join(parts), text)
        clauses = secrets.query(secrets.Rule("x", "".join(parts)))
        assert not clauses or any(all(g in text.lower() for g in c) for c in clauses), (parts, text)


def test_decontaminate(spark, docs, empty):
    items = [("b", PASSAGE), ("a", "One two"), ("c", prose(300, 8)[40:400]), (None, PASSAGE), ("d", None), ("e", "..."), ("f", "Éa1"), ("g", "éA1")]
    bench = spark.createDataFrame(items, "item_id string, text string").withColumn("n_hit", F.lit(1))
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))
    for found in (decontaminate.judge(docs, bench).collect(),):
        assert len(found) == len(rows())
        by_text = {(r[0], r[1]) for r in rows()}
        texts = {(i, t): words(t) for i, t in by_text}
        got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found)
        want = Counter()
        for i, t, *_ in rows():
            w, hit, names = texts[i, t], set(), set()
            for name, item in items:
                v = words(item)
                n = min(len(v), 10)
                for k in range(len(v) - n + 1) if n else ():
                    for at in range(len(w) - n + 1):
                        if w[at : at + n] == v[k : k + n]:
                            hit |= set(range(at, at + n))
                            names |= {name} - {None}
            want[i, len(w), len(hit), tuple(sorted(names)), bool(hit)] += 1
        assert got == want
    assert decontaminate.judge(empty, bench).count() == 0
    assert decontaminate.judge(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.clean(docs, bench).columns == docs.columns


def shingled(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("k,percent,bound", [(4, 85, None), (5, 80, None), (4, 85, 0), (4, 85, 8), (5, 80, 24)])
def test_ngram_join(spark, monkeypatch, k, percent, bound):
    if bound is not None:
        monkeypatch.setattr(ngram_join, "boundary", lambda *_: bound)
    more = [(100 + i, edits(prose(random.Random(i).randrange(4, 60), i % 7), i % 4, i)) for i in range(150)]
    data = [(r[0], r[1]) for r in rows()] + more
    found = ngram_join.judge(spark.createDataFrame(data, "doc_id long, text string").repartition(4), ngram_join.Settings(k, percent)).collect()
    sets = [shingled(t, k) for _, t in data]
    root = list(range(len(data)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and None not in (data[i][0], data[j][0]):
                root[top(i)] = top(j)
    least = {}
    for i, (name, _) in enumerate(data):
        if name is not None:
            least[top(i)] = min(least.get(top(i), name), name)
    want = Counter((data[i][0], len(sets[i]), None if data[i][0] is None else least[top(i)]) for i in range(len(data)))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == want


def test_ngram_join_hot_group_and_edges(spark, empty, docs):
    group = [(i, edits(BASE, i % 3, i)) for i in range(400)]
    found = ngram_join.judge(spark.createDataFrame(group, "doc_id long, text string")).collect()
    sets = {i: shingled(t, 4) for i, t in group}
    alone = [i for i, _ in group if not any(j != i and 100 * len(sets[i] & s) >= 85 * len(sets[i] | s) for j, s in sets.items())]
    assert {r.doc_id for r in found if r.component_id == r.doc_id} >= set(alone)
    assert sum(r.component_id == 0 for r in found) == 400 - len(alone)
    assert ngram_join.judge(empty).count() == 0
    kept = ngram_join.first_of_each(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {0, 1, 2, None}


def test_ngram_join_without_ids(spark):
    own, other = prose(80, 11), prose(80, 12)
    data = [(5, BASE, "a"), (9, edits(BASE, 1, 1), "b"), (None, BASE, "c"), (None, edits(BASE, 1, 2), "d"), (None, own, "f"), (None, own, "e"), (None, edits(own, 1, 3), "g"), (None, other, "h"), (None, "", "i"), (None, None, "j"), (None, "", "i")]
    kept = ngram_join.first_of_each(spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(3))
    found = sorted(r.lang for r in kept.collect())
    assert kept.columns == ["doc_id", "text", "lang"] and len(found) == 6
    assert found in (["a", "e", "h", "i", "i", "j"], ["a", "g", "h", "i", "i", "j"])


def test_fingerprints(spark, docs, empty):
    found = fingerprint.with_next(docs).collect()
    assert len(found) == len(rows())
    order = sorted({(r[0], r[1] or "") for r in rows()}, key=lambda x: (x[0] is None, x[0] or 0))
    for r in found:
        k = next(i for i, (name, _) in enumerate(order) if name == r.doc_id)
        t, after = order[k][1], order[(k + 1) % len(order)][1]
        half = len(t) // 2
        e = t[: len(t) - half] + after[:half]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert r.fingerprint == fingerprint.fingerprint(t) and r.edited_fingerprint == fingerprint.fingerprint(e)
        assert r.near_next == fingerprint.likeness(r.fingerprint, fingerprint.fingerprint(after)) and 0 <= r.near_edited <= 1
    assert fingerprint.with_next(empty).count() == 0
    long = prose(5000, 3)
    assert fingerprint.likeness(fingerprint.fingerprint(long), fingerprint.fingerprint(edits(long, 2, 1))) > 0.8
    assert fingerprint.likeness(fingerprint.fingerprint(long), fingerprint.fingerprint(prose(5000, 99))) < 0.4


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    for _ in range(400):
        a, b = ("".join(R.choice("abc") for _ in range(R.randrange(0, 70))) for _ in range(2))
        assert fingerprint.distance(a, b) == plain(a, b)


def test_url_filter(spark):
    urls = [None, "no scheme", "http://A.Example.ORG/es/x?y", "https://example.org/en/123#t", "http://x.org", "http://x.org/", "ftp://a.com/fr/1", "http://com/de/2", "http://badexample.org/es/", "http://a.net/de/9"]
    urls += [f"http://m{k}.com/{'fr' if k % 2 else 'de'}/{k}" for k in range(60)] + [f"https://q{k}.net/de/{k}" for k in range(20)]
    d = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls + urls[:3])], "page_id long, url string, verdict string")
    found = {r.page_id: r for r in url_filter.judge(d).collect()}
    assert len(found) == len(urls) + 3
    for i, r in found.items():
        u = (urls + urls[:3])[i]
        host = re.match(r"(?s).*?://([^/?#]*)", u) if u and "://" in u else None
        h = host[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) if host else ""
        p = re.match(r"[^?#]*", u[host.end() :])[0] if host else ""
        fits = [(len(n + s), n + s, v) for v, n, s in url_filter.BASE_RULES if (h == n or h.endswith("." + n)) and p.startswith(s)]
        want = max(fits, default=(0, None, None))
        assert (r.host, r.path, r.rule) == (h, p, want[1]), u
        assert r.verdict == (want[2] or r.verdict) and r.verdict in ("allow", "block")
    assert found[urls.index("http://a.net/de/9")].verdict == "block"  # mined: what the base rules block on .com
    assert url_filter.judge(d.limit(0)).count() == 0


@pytest.mark.parametrize("bad,good", [("s{}.net/a/b/c/ads/x", "s{}.net/a/b/c/news/x"), ("ads.x.y.s{}.net/", "www.x.y.s{}.net/"), ("s{}.net/?utm_source=feed", "s{}.net/?utm_source=mail"), ("s{}.net/?a=1&ad=2", "s{}.net/?a=1&page=2")])
def test_url_patterns_in_every_part(spark, bad, good):
    urls = [(f"http://{x.format(k)}", v) for k in range(20) for x, v in ((bad, "block"), (good, "allow"))]
    rules = url_filter.mine(spark.createDataFrame(urls, "url string, verdict string"))
    new = spark.createDataFrame([(f"http://{x.format(77)}", v) for x, v in ((bad, "block"), (good, "allow"))], "url string, want string")
    found = {r.url: r.mined_verdict for r in url_filter.match(new, rules).collect()}
    assert found == {r.url: r.want for r in new.collect()}


def test_toxicity(spark, empty):
    r, draw = random.Random(2), random.Random(3)
    data, labels = [], []
    for i in range(1200):
        bad = i % 6 == 0
        t = prose(r.randrange(5, 80), i) + (" foulword" if bad else "") + (" grumm" + r.choice("abcdef") + "x" if bad and i % 4 == 0 else "")
        data.append((i, t))
        if draw.random() < 0.5:  # whatever the text: the prior is the toxic share of what is labelled
            labels.append((i, int(bad), 1))
    docs = spark.createDataFrame([*data, (5000, None), (5001, ""), (None, "x foulword")], "doc_id long, text string").withColumn("score", F.lit(9))
    told = spark.createDataFrame([*labels, (3, None, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, told, ~toxicity.held_out(F.col("doc_id")))
    found = {x.doc_id: x for x in toxicity.score(docs, model).collect()}
    held = [i for i, _ in data if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(x.score is not None and 0 <= x.score <= 1 for x in found.values())
    right = sum(found[i].predicted == (i % 6 == 0) for i in held)
    assert right / len(held) > 0.97 and found[5001].predicted == 0 and found[5000].score == found[5001].score
    assert toxicity.score(empty.select("doc_id", "text"), model).count() == 0
    none = toxicity.train(empty, told.limit(0))
    assert {x.score for x in toxicity.score(docs, none).collect()} == {0.0}


def test_toxicity_of_random_labels(spark):
    """Weak words, labels drawn at random: the estimated risk falls below zero long before the fit is done."""
    r, letters = random.Random(1), "abcdefghijklmnopqrstuvwxyz"
    data, labels, toxic = [], [], set()
    for i in range(1200):
        words = ["w" + r.choice(letters) + r.choice(letters) for _ in range(r.randrange(5, 80))]
        if r.random() < 0.13:
            toxic.add(i)
            words += [f"foul{letters[k % 26]}{letters[k // 26]}" for k in r.sample(range(40), 5)]
        elif r.random() < 0.3:
            k = r.randrange(40)
            words.append(f"foul{letters[k % 26]}{letters[k // 26]}")
        data.append((i, " ".join(words)))
        if r.random() < 0.4:
            labels.append((i, int(i in toxic)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), ~toxicity.held_out(F.col("doc_id")))
    said = {x.doc_id for x in toxicity.score(docs, model).filter("predicted = 1").collect()}
    held = {i for i, _ in data if zlib.crc32(str(i).encode()) % 4 == 2}
    assert len(held & said & toxic) >= 0.7 * len(held & toxic) and len(held & (said ^ toxic)) <= 0.1 * len(held)


def test_risk_gradients():
    """Each step's direction is that of the estimated risk: up the negative part where that is below zero (Kiryo et al.)."""
    g = np.random.default_rng(2)
    n, m, prior = 30, 70, 0.3

    def risk(f, clipped):
        pos, neg = np.logaddexp(0, -f[:n]).mean(), np.logaddexp(0, f[n:]).mean() - prior * np.logaddexp(0, f[:n]).mean()
        return (prior * pos + neg if neg >= 0 else -neg) if clipped else prior * pos + max(neg, 0)

    for shift in (-6, 0, 6):
        f = g.normal(0, 1, n + m) + np.where(np.arange(n + m) < n, shift, -shift)
        slope = toxicity.slopes(f, n, prior)
        for k in (0, n - 1, n, n + m - 1):
            e = np.zeros(n + m)
            e[k] = 1e-6
            assert slope[k] == pytest.approx((risk(f + e, True) - risk(f - e, True)) / 2e-6, abs=1e-6)


def test_language_id(spark):
    texts = {"en": "the house and the garden of the town with a river", "de": "das Haus und der Garten der Stadt mit einem Fluss", "fr": "la maison et le jardin de la ville avec une rivière"}
    r = random.Random(3)
    say = lambda l, n: " ".join(r.choice(texts[l].split()) for _ in range(n))
    docs = spark.createDataFrame([(i, say(l, 60), l) for i in range(60) for l in texts] + [(999, None, None)], "doc_id long, text string, lang string")
    model = lang_id.train(docs)
    assert model[0] == ["de", "en", "fr"]
    pages, truth = [], {}
    for i in range(300):
        l = list(texts)[i % 3]
        truth[i] = l
        body = say(l, 30) if i % 10 else ""
        pages.append((i, f"http://h{i % 3}.site{i % 3}.{ {'en': 'org', 'de': 'de', 'fr': 'fr'}[l]}/p", f'<html lang="{l if i % 7 else "xx"}"><body><p>{body}</p></body></html>'))
    pages += [(1000, None, None), (1001, "bad", "")]
    found = {x.page_id: x for x in lang_id.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()}
    assert len(found) == 302
    assert sum(found[i].lang == l for i, l in truth.items()) / 300 > 0.97
    assert all(0 < x.probability <= 1 for x in found.values())
    assert lang_id.judge(spark.createDataFrame([], "page_id long, url string, html string"), model).count() == 0


def test_line_dedup(spark, empty):
    line = prose(20, 3)
    near = line.rsplit(" ", 1)[0] + " changed"
    data = [(1, line + "\n" + prose(15, 4) + "\n\n"), (2, near + "\nshort\n" + prose(15, 4).upper()), (3, "short\nother words here"), (4, None), (5, ""), (3, "short\nother words here"), (6, "\n".join(prose(9, k) for k in range(300))), (7, prose(9, 5) + " \n" + line)]
    found = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(data, "doc_id long, text string").withColumn("n_lines", F.lit(1))).collect()}
    order = sorted({(i, t) for i, t in data if t is not None})
    seen, want = [], {}
    for i, t in order:
        kept = []
        for one in t.split("\n"):
            s = frozenset(w for w in re.split(r"\s+", one.lower()) if w)
            if s and any(100 * len(s & x) >= 80 * len(s | x) for x in seen):
                seen.append(s)
                continue
            if s:
                seen.append(s)
            kept.append(one)
        want[i] = "\n".join(kept)
    assert {i: found[i].text for i in want} == want and found[4].text is None and found[4].n_removed == 0
    assert line_dedup.dedup(empty).count() == 0


def test_long_lines_that_share_words_are_not_all_compared(spark, monkeypatch):
    """Sketches tell nothing of long lines; the words that their prefixes share do, and no link is lost by it."""
    r = random.Random(3)
    data = [(i, " ".join(r.sample([f"w{k}" for k in range(800)], 200))) for i in range(40)]
    for i, (at, n) in enumerate([(3, 5), (3, 15), (7, 22), (9, 23), (11, 40)]):
        words = data[at][1].split(" ")
        data.append((100 + i, "\n".join([" ".join(words[n:] + [f"new{i}x{k}" for k in range(n)]), f"a\vb c{i}"])))
    wrote, write = {}, line_dedup.materialize

    def told(df, name):
        out = write(df, name)
        wrote[name] = out.count()
        return out

    monkeypatch.setattr(line_dedup, "materialize", told)
    found = {x.doc_id: x.n_removed for x in line_dedup.dedup(spark.createDataFrame(data, "doc_id long, text string").repartition(2)).collect()}
    # 200 words of which n are others: 200 - n in common, 200 + n in all
    assert {i for i, n in found.items() if n} == {100, 101, 102} and wrote["pairs"] < 20


def joined(spark, run):
    """What run() returns, and the most rows that a join of it made."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = {store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())}
    out, most = run(), 0
    spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    for i in range(store.executionsList().size()):
        if (one := store.executionsList().apply(i).executionId()) not in before:
            nodes, made = store.planGraph(one).allNodes(), store.executionMetrics(one)
            for node in (nodes.apply(k) for k in range(nodes.size())):
                told = [m.accumulatorId() for m in (node.metrics().apply(k) for k in range(node.metrics().size())) if m.name() == "number of output rows"]
                if "Join" in node.name() and told and made.contains(told[0]):
                    most = max(most, int(made.apply(told[0]).replace(",", "")))
    return out, most


def test_lines_meet_few_others_and_lose_no_link(spark):
    """Near copies of all sizes, at both sides of the limit and in any order of words, among long lines that share words."""
    r = random.Random(5)
    said = [r.sample([f"w{k}" for k in range(20_000)], n) for n in [*range(1, 60), 63, 64, 65, 92, 93, 117, 146, 147, 184, 231, 255, 256, 257, 319, 320]]
    near = []
    for one in said:
        for fewer, more in ((0, 0), (len(one) // 5, 0), (len(one) // 5 + 1, 0), (0, len(one) // 4), (0, len(one) // 4 + 1), (len(one) // 9, len(one) // 9), (len(one) // 9 + 1, len(one) // 9)):
            changed = one[fewer:] + [f"new{len(near)}x{k}" for k in range(more)]
            near.append(r.sample(changed, len(changed)))
    data = said + near + [r.sample([f"w{k}" for k in range(20_000)], r.randrange(180, 220)) for _ in range(600)]
    r.shuffle(data)
    run = lambda: {x.doc_id: x.n_removed for x in line_dedup.dedup(spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(data)], "doc_id long, text string").repartition(3)).collect()}
    found, most = joined(spark, run)
    sets = [set(x) for x in data]
    assert found == {i: int(bool(x) and any(5 * len(x & y) >= 4 * len(x | y) for y in sets[:i])) for i, x in enumerate(sets)}
    assert most < 5_000, most


def test_ranges_of_sizes_hold_partners():
    for percent in (50, 80, 95, 100):
        number, end = line_dedup.ranges(percent)
        at = lambda n: number[min(n, line_dedup.LONGEST - 1)]
        for n in range(1, 2 * line_dedup.LONGEST):
            most = n * 100 // percent
            assert at(most) - at(n) in (0, 1) and (at(most) == at(n) or at(end[n]) == at(n) + 1 == at(end[n] - 1) + 1)


def rarity_of(sets):
    """Exact: every hash is told by itself."""
    value, count = np.unique(np.concatenate(sets), return_counts=True)
    value, count = value[count > 1], count[count > 1]
    bits = np.zeros(1 << 20, np.uint8)
    bits[value >> np.uint64(44)] = 1
    return ngram_join.Rarity(np.packbits(bits), value[count > 3], np.log2(count[count > 3]).astype(np.uint8), 0)


def test_lists_and_sketches_hold_links():
    """Every linking pair of random sets meets in a list, small or large, wherever the boundary is, and is close."""
    g = np.random.default_rng(5)
    pool = np.unique(g.integers(0, 2**63, 400, dtype=np.uint64) * np.uint64(2))
    for percent in (80, 85):
        pairs = []
        for _ in range(300):
            n = int(g.integers(1, 90))
            a = np.unique(g.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)) if g.random() < 0.5 else np.unique(g.choice(pool, n))
            cut, new = int(g.integers(0, 2 + n // 6)), int(g.integers(0, 2 + n // 6))
            pairs.append((a, np.unique(np.concatenate([g.permutation(a)[cut:], g.integers(0, 2**63, new, dtype=np.uint64)]))))
        rarity = rarity_of([s for p in pairs for s in p])
        for bound in (0, 5, 9, 13):
            for a, b in pairs:
                common = len(np.intersect1d(a, b))
                if len(b) and 100 * common >= percent * (len(a) + len(b) - common):
                    assert set(ngram_join.keys(a, percent, bound, rarity).tolist()) & set(ngram_join.keys(b, percent, bound, rarity).tolist()), (percent, len(a), len(b), common)
                    assert ngram_join.close([len(a), len(b)], [ngram_join.sketch(a), ngram_join.sketch(b)], percent).all()
    long = np.unique(g.integers(0, 2**64, 3000, dtype=np.uint64))
    sets = [long, long[40:], np.unique(g.integers(0, 2**64, 3100, dtype=np.uint64)), long[:1500]]
    assert ngram_join.close([len(s) for s in sets], [ngram_join.sketch(s) for s in sets], 85).tolist() == [True, True, False, False]


def test_long_texts_are_shingled_in_pieces(monkeypatch):
    texts = [prose(700, 1), "", prose(30, 2), "x" * 3000 + " " + prose(50, 3), " \n" * 400 + "end", None, "y" * 5000]
    whole = ngram_join.shingle_sets(texts, 4)
    monkeypatch.setattr(ngram_join, "BATCH_BYTES", 100)
    assert all((a == b).all() and len(a) == len(shingled(t, 4)) for a, b, t in zip(whole, ngram_join.shingle_sets(texts, 4), texts, strict=True))


def test_rarities_are_counts(spark):
    texts = [prose(random.Random(i).randrange(30, 80), i % 40) for i in range(120)]
    sets = ngram_join.shingle_sets(texts, 4)
    rarity, scan = ngram_join.rarities(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), 4, sum(map(len, sets)))
    value, count = np.unique(np.concatenate(list({ngram_join.signature(s): s for s in sets}.values())), return_counts=True)
    assert (rarity.of(value)[count > 1] > 0).all() and scan >= 2
    alone = np.array([h for h in np.unique(np.concatenate(ngram_join.shingle_sets([prose(400, 10**6)], 4))) if h not in set(value.tolist())], np.uint64)
    assert (rarity.of(np.sort(alone)) > 0).mean() < 0.2


def test_boundary_by_cost():
    few, many = {n: 1000 for n in range(1, 30)}, {n: 1000 for n in range(1, 30)}
    assert ngram_join.boundary(85, few, 0.0) <= ngram_join.boundary(85, many, 200.0) and ngram_join.boundary(85, {}, 1.0) == 0


def test_columns_of_any_name(spark):
    """What operators call their own columns may stand in a table."""
    names = ("_id", "_d", "_key", "_kinds", "_of", "_url", "_host", "own", "row", "key", "body", "lines", "kinds", "candidate", "known", "d", "s", "t", "draw", "hit_id", "text_key", "class", "first", "a.b")
    docs = spark.createDataFrame([(1, BASE, "s1"), (2, BASE, "s1"), (3, PASSAGE, None), (None, None, "s2")], "doc_id long, text string, source string")
    docs = docs.withColumns({n: F.lit(n) for n in names})
    bench = spark.createDataFrame([("b", PASSAGE)], "item_id string, text string")
    for out in (mixing.draw(docs), secrets.scan(docs), decontaminate.clean(docs, bench), ngram_join.first_of_each(docs), line_dedup.dedup(docs)):
        assert out.columns[: len(docs.columns)] == docs.columns and {r["_id"] for r in out.collect()} == {"_id"}
    pages = spark.createDataFrame([(1, "http://a.org/x", "<p>x</p>")], "page_id long, url string, html string").withColumns({n: F.lit(n) for n in names if n not in ("html",)})
    model = lang_id.train(docs.select("doc_id", "text").withColumn("lang", F.lit("en")))
    for out in (url_filter.judge(pages), lang_id.judge(pages, model)):
        assert {(r["_host"], r["a.b"]) for r in out.collect()} == {("_host", "a.b")}


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("b", BASE), ("a", edits(BASE, 1, 1)), (None, edits(BASE, 1, 2))], "doc_id string, text string")
    assert {r.doc_id for r in ngram_join.first_of_each(docs).collect()} == {"a"}
    assert {r.doc_id: r.component_id for r in ngram_join.judge(docs).collect()} == {"a": "a", "b": "a", None: None}


def test_few_rows_mine_nothing(spark):
    urls = [(f"http://h{k}.com/{'de' if k % 2 else 'fr'}/{k}?a={k}&b=1&c=2&d=3&e=4&f=5&g=6&h=7", "block" if k % 2 else "allow") for k in range(7)]
    assert url_filter.mine(spark.createDataFrame(urls, "url string, verdict string")).count() == 0


def shared_out(sizes, weights, total, most):
    """Targets by another way: a level such that min(most * size, level * weight) adds up to total, by bisection."""
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(most * s, level * w) for s, w in zip(sizes, weights, strict=True)) < total else (low, level)
    return [min(most * s, low * w) for s, w in zip(sizes, weights, strict=True)]


def test_mixing_against_brute_force(spark, docs):
    """Targets, draws and positions of every document, the order of documents alone taken from the engine's hash."""
    c = mixing.Curriculum()
    keyed = docs.select("doc_id", "source", "text", F.xxhash64(F.lit(c.seed), "doc_id", "text").alias("k"), F.xxhash64("text").alias("t")).collect()
    names = sorted({r.source for r in keyed}, key=lambda s: (s is None, s or ""))
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    sizes = [sum(size(r) for r in keyed if r.source == n) for n in names]
    schedules = [c.schedules[k % 3] for k in range(len(names))]

    def height(schedule, x):
        return next(v + (w - v) * (x - a) / (b - a) for (a, v), (b, w) in zip(schedule, schedule[1:], strict=False) if a <= x <= b)

    def demand(schedule, x, steps=2000):
        """The integral up to x, by trapezoids."""
        at = np.linspace(0, x, steps + 1)
        y = np.array([height(schedule, min(z, 1.0)) for z in at])
        return float(((y[1:] + y[:-1]) / 2 * np.diff(at)).sum())

    whole = [demand(s, 1.0) for s in schedules]
    assert whole == pytest.approx([(5, 2, 1)[k % 3] for k in range(len(names))], rel=1e-3)
    want = shared_out(sizes, [(5, 2, 1)[k % 3] for k in range(len(names))], 1.5 * sum(sizes), 2.0)
    found = {}
    for r in mixing.plan(docs).collect():
        found.setdefault((r.doc_id, r.source, r.text_key), []).append(r)
    for n, total, target, schedule, area in zip(names, sizes, want, schedules, whole, strict=True):
        begin = 0
        for r in sorted((r for r in keyed if r.source == n), key=lambda r: (r.k, r.doc_id is not None, r.doc_id or 0, r.t)):
            expected = []
            for repeat in (0, 1):
                taken = min(max(int(target + 1e-6) - repeat * total - begin, 0), size(r))
                if taken:
                    expected.append((repeat, taken, (repeat * total + begin + taken / 2) / target))
            got = found[r.doc_id, n, r.t].pop(0) if len(found[r.doc_id, n, r.t]) == 1 else found[r.doc_id, n, r.t].pop([len(x.draws) for x in found[r.doc_id, n, r.t]].index(len(expected)))
            assert got.target == pytest.approx(target) and [(x.repeat, x.taken) for x in got.draws] == [e[:2] for e in expected] or r.doc_id in (0, 6)
            for x, e in zip(got.draws, expected, strict=True):
                if r.doc_id not in (0, 6):  # rows that occur twice change places
                    assert demand(schedule, x.position) / area == pytest.approx(min(e[2], 1.0), abs=2e-3)
            begin += size(r)


def plain_fingerprint(text):
    """Byte by byte: a rolling hash of seven bytes cuts, each piece's own hash gives a letter."""
    data, root, full = text.encode(), int(fingerprint._ROOT), (1 << 64) - 1

    def hashed(part):
        h = 0
        for k, x in enumerate(part):
            h = (h + (x + 1) * pow(root, k, 1 << 64)) & full
        h = (h ^ h >> 31) * 0xBF58476D1CE4E5B9 & full
        return h ^ h >> 29

    size = 3
    while size * 64 < len(data):
        size *= 2

    def signature(size):
        out, begin = "", 0
        for k in range(1, len(data) + 1):
            if len(out) < 63 and (hashed(data[max(0, k - 7) : k]) >> 33) % size == size - 1:
                out, begin = out + fingerprint.LETTERS[hashed(data[begin:k]) >> 58], k
        return out + fingerprint.LETTERS[hashed(data[begin:]) >> 58] if begin < len(data) else out

    while len(signature(size)) < 32 and size > 3:
        size //= 2
    return f"{size}:{signature(size)}:{signature(2 * size)}" if data else "3::"


def test_fingerprints_against_a_plain_version():
    for text in ["", "a", "é", "abc" * 50, BASE, prose(300, 8), prose(900, 3), "x" * 700]:
        assert fingerprint.fingerprint(text) == plain_fingerprint(text), text[:30]


def test_mined_rules_against_brute_force(spark):
    """Support, confidence, pruning and the best rule, over all combinations of the tokens kept."""
    from itertools import combinations

    r = random.Random(6)
    urls = sorted({f"http://{r.choice(['a', 'b', 'ads'])}.{r.choice(['x', 'y'])}.net/{r.choice(['p', 'q'])}/{r.choice(['', '?k=1', '?k=1&z'])}#{k % 3 or ''}" for k in range(400)})
    data = [(u, "block" if "ads" in u or ("/q/" in u and "y.net" in u) else "allow") for u in urls]
    settings = url_filter.Settings(least_support=0.1, least_rows=4)
    d = spark.createDataFrame(data, "url string, verdict string")
    kept = d.select("url", "verdict", url_filter.tokens(F.col("url"), settings).alias("t")).collect()
    n, least = len(kept), max(0.1, 4 / len(kept))
    rows_of = {}
    for k, row in enumerate(kept):
        for x in row.t:
            rows_of.setdefault(x, set()).add(k)
    names = {}
    for x in sorted(rows_of):
        if len(rows_of[x]) >= least * n:
            names.setdefault(frozenset(rows_of[x]), x)
    every = {}
    for size in range(1, 6):
        for some in combinations(sorted(names.values()), size):
            rows = frozenset.intersection(*[frozenset(rows_of[x]) for x in some])
            for verdict in ("allow", "block"):
                both = sum(kept[k].verdict == verdict for k in rows)
                if both >= least * n and both >= settings.least_confidence * len(rows):
                    every[some, verdict] = (both / len(rows), both / n)
    want = {k: v for k, v in every.items() if not any(b[1] == k[1] and set(b[0]) < set(k[0]) and w[0] >= v[0] for b, w in every.items())}
    rules = url_filter.mine(d, settings)
    found = {(tuple(x.tokens), x.verdict): (x.confidence, x.support) for x in rules.collect()}
    assert set(found) == set(want) and want and all(found[k] == pytest.approx(want[k]) for k in want)
    got = {x.url: (x.mined_verdict, x.mined_rule) for x in url_filter.match(d, rules, settings).collect()}
    for row in kept:
        fits = [(round(v[0], 9), round(v[1], 9), -len(k[0]), " ".join(k[0]), k[1]) for k, v in want.items() if set(k[0]) <= set(row.t)]
        best = max(fits, default=None)
        assert got.get(row.url, (None, None)) == ((best[4], best[3]) if best else (None, None)), row.url


def test_posteriors_against_brute_force(spark):
    texts = {"en": "the house and the garden of the town with a river", "de": "das Haus und der Garten der Stadt mit einem Fluss", "fr": "la maison et le jardin de la ville avec une rivière"}
    r = random.Random(3)
    say = lambda l, n: " ".join(r.choice(texts[l].split()) for _ in range(n))
    model = lang_id.train(spark.createDataFrame([(i, say(l, 40), l) for i in range(20) for l in texts], "doc_id long, text string, lang string"))
    langs, table = model
    pages = [(i, f"http://h{i % 5}.site{i % 2}.{['org', 'de'][i % 2]}/p", f'<html lang="{r.choice([*langs, "xx"])}"><p>{say(r.choice(langs), i % 4 * 3)}</p></html>') for i in range(60)]
    pages += [(100, None, None), (101, "bad", ""), (3, *pages[3][1:])]
    d = spark.createDataFrame(pages, "page_id long, url string, html string")
    s, rows = lang_id.Settings(), []
    for p in d.select("*", lang_id.visible(F.col("html")).alias("text"), lang_id.declared(F.col("html")).alias("declared")).collect():
        at = lang_id.trigram_counts(p.text if p.text and p.text.strip() else "")
        ll = table.astype(np.float32)[:, at].sum(1, dtype=np.float64) * min(s.temper, s.most / max(len(at), 1)) if len(at) > 3 else np.zeros(3)
        host = (re.match(r".*?://([^/?#:]*)", p.url or "") or [None, ""])[1].lower()
        rows.append((p.page_id, host, host.split(".")[-1], ".".join(host.split(".")[-2:]), p.declared, ll - ll.max()))
    share = [np.exp(x[5]) / np.exp(x[5]).sum() for x in rows]
    total = lambda of: sum((p for p, x in zip(share, rows, strict=True) if of(x)), np.zeros(3))
    whole = total(lambda x: True)
    prior = (whole + 1) / (whole.sum() + 3)
    want = {}
    for p, x in zip(share, rows, strict=True):
        host, domain = total(lambda y: y[1] == x[1]), total(lambda y: y[3] == x[3])
        hn, dn = sum(y[1] == x[1] for y in rows), sum(y[3] == x[3] for y in rows)
        of_domain = (np.maximum(domain - host, 0) + s.domain_weight * prior) / (dn - hn + s.domain_weight)
        of_host = (np.maximum(host - p, 0) + s.host_weight * of_domain) / (hn - 1 + s.host_weight)
        seen = [np.log((total(lambda y: y[k] == x[k]) + s.smooth) / (whole + 50 * s.smooth)) for k in (2, 4)]
        score = x[5] + seen[0] + seen[1] + np.log(of_host)
        post = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
        want[x[0]] = (langs[int(post.argmax())], float(post.max()))
    for x in lang_id.judge(d, model).collect():
        assert x.lang == want[x.page_id][0] and x.probability == pytest.approx(want[x.page_id][1], abs=1e-6)
