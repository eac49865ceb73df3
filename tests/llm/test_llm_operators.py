"""Operators against brute force on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallystrata.llm import bloom, contamination, exact, language, mixing, near, pii, pitman_yor, repeats, text, tokens, urls
from tallystrata.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(s):
    return re.sub("[A-Z]", lambda m: m.group().lower(), s or "")


def corpus(seed=1, n=160, letters="abcdefghij"):
    """Texts that share passages, with copies and edited copies, a null, empty ones, and a long one."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(n // 2)]
    while len(texts) < n:
        words = rng.choice(texts).split()
        for _ in range(rng.choice((0, 0, 1, 2))):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words) if rng.random() < 0.8 else " ".join(words).upper())
    texts += [None, "", "  \n", "é", " ".join(rng.choices(vocabulary, k=20_000)), texts[0], texts[0]]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string").cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def brute_components(sets, percent=80):
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def shingle_sets(rows, size):
    out = {}
    for i, t in rows:
        w = WORD.findall(low(t))
        out[i] = frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, size):
    sets = shingle_sets(corpus(), size)
    expected = brute_components(sets)
    found = by_id(near.near_duplicates(docs, size=size))
    assert {k: (r.n_shingles, r.component_id, r.kept) for k, r in found.items()} == {
        k: (len(sets[k]), expected[k], expected[k] == k) for k in sets
    }


def test_near_duplicates_with_null_and_repeated_ids(spark):
    words = [f"w{k}" for k in range(40)]
    a, b, near_a = " ".join(words), " ".join(reversed(words)), " ".join(words[:-1] + ["x"])
    rows = [(1, a), (2, a), (2, b), (None, near_a), (None, "only under no id, and long enough"), (None, None), (3, ""), (3, ""), (4, a), (4, a)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n int")
    found = near.near_duplicates(docs, size=2)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()), key=repr) == sorted(
        [(1, 39, 1, True), (2, 39, 1, False), (2, 39, 2, True), (None, 39, 1, False), (None, 6, None, True), (None, 0, None, True),
         (3, 0, 3, True), (3, 0, 3, True), (4, 39, 1, False), (4, 39, 1, False)], key=repr)
    kept = near.keep_first(docs, size=2)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, a), (2, b), (None, "only under no id, and long enough"), (None, None), (3, ""), (3, "")], key=repr)


def test_keep_first_keeps_one_of_repeated_rows(spark):
    words = " ".join(f"w{k}" for k in range(40))
    same_set = words.replace(" ", "  ")
    rows = [(5, words), (5, words), (5, same_set), (None, "no id here"), (None, "no id here"), (9, words + " y")]
    kept = near.keep_first(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 5] and {r.text for r in kept if r.doc_id} <= {words, same_set}


def test_near_duplicates_of_nothing(nothing):
    assert near.near_duplicates(nothing).collect() == []


def test_components_of_long_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    other = [("b", "c"), ("é", "b"), ("x", "y")]
    shape = "a long, b long"
    one, none, half = components(spark.createDataFrame(edges, shape), spark.createDataFrame([], shape), spark.createDataFrame(edges[:30], shape))
    assert {r.id: r.label for r in one.collect()} == {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 140)}
    assert none.collect() == []
    assert {r.id: r.label for r in half.collect()} == {k: 1 for k in range(1, 32)}
    texts = components(spark.createDataFrame(other, "a string, b string"))[0]
    assert {r.id: r.label for r in texts.collect()} == {"b": "b", "c": "b", "é": "b", "x": "x", "y": "x"}


def test_exact_classes(docs):
    groups = collections.defaultdict(list)
    for i, t in corpus():
        groups[low(t)].append(i)
    expected = {
        i: (max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g
    }
    assert {k: tuple(r)[1:] for k, r in by_id(exact.classes(docs)).items()} == expected


def test_exact_ties_nulls_and_extra_columns(spark, nothing):
    rows = [(1, "A", "x"), (1, "a", "y"), (None, None, "z"), (None, "", "z"), (5, "b", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    assert sorted(r.text or "" for r in exact.drop_duplicates(df).collect()) in (["", "A", "b"], ["", "a", "b"])
    assert exact.drop_duplicates(df).columns == df.columns
    assert exact.classes(nothing).collect() == [] and exact.drop_duplicates(nothing).collect() == []


def brute_repeats(rows, length, keep):
    seen, gone = collections.defaultdict(list), {}
    raw = {i: (t or "").encode() for i, t in rows}
    for i in sorted(raw):
        gone[i] = bytearray(len(raw[i]))
        for q in range(len(raw[i]) - length + 1):
            seen[raw[i][q : q + length]].append((i, q))
    for places in seen.values():
        if len(places) > 1:
            for i, q in places if keep == "none" else places[1:]:
                gone[i][q : q + length] = b"\1" * length
    return {
        i: (len(b), sum(gone[i]), len([x for x in bytes(gone[i]).split(b"\0") if x]), bytes(x for x, g in zip(b, gone[i]) if not g))
        for i, b in raw.items()
    }


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("crowd", [2, 4096])
def test_repeats(spark, monkeypatch, keep, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rng = random.Random(3)
    base = ["".join(rng.choices("ab", k=60)) for _ in range(6)]
    rows = [(i, "".join(rng.choice(base)[rng.randrange(20) : rng.randrange(30, 60)] for _ in range(rng.randrange(8)))) for i in range(120)]
    rows += [(201, None), (202, ""), (203, "a" * 500), (204, "é" * 40), (205, "a" * 20), (206, base[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = by_id(repeats.remove_repeats(df, length=20, keep=keep))
    assert {k: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for k, r in found.items()} == brute_repeats(rows, 20, keep)


def test_longest_previous_factors():
    rng = np.random.default_rng(1)
    s = bytes(rng.integers(97, 99, 80).tolist())
    order = sorted(range(len(s)), key=lambda i: s[i:])
    match = lambda i, j: next((k for k in range(len(s)) if i + k >= len(s) or j + k >= len(s) or s[i + k] != s[j + k]))
    lcp = np.array([0] + [match(a, b) for a, b in zip(order, order[1:])])
    found = repeats.longest_previous(lcp, np.array(order), 1)
    assert found.tolist() == [max([match(i, j) for j in range(i)], default=0) for i in order]


def test_contamination(spark, docs):
    items = [(1, corpus()[3][1]), (2, corpus()[3][1]), (3, "a"), (4, None), (5, "zz yy"), (6, corpus()[5][1].upper().replace(" ", ", "))]
    words = lambda s: re.findall(r"(?:[A-Za-z0-9]|[^\x00-\x7f])+", (s or "").lower())
    grams = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    expected = {}
    for i, t in corpus():
        expected[i] = [
            k for k, s in items if words(s)
            for n in [min(5, len(words(s)))]
            if 100 * len(grams(words(s), n) & grams(words(t), n)) >= 80 * len(grams(words(s), n))
        ]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = by_id(contamination.contamination(docs, table))
    assert {k: list(r.item_ids) for k, r in found.items()} == expected
    assert any(expected.values()) and all(r.contaminated == bool(r.item_ids) for r in found.values())
    kept = {r.doc_id for r in contamination.drop_contaminated(docs, table).collect()}
    assert kept == {k for k, v in expected.items() if not v}
    assert contamination.contamination(docs, table.filter("false")).filter("contaminated").isEmpty()


def test_sketches_cannot_miss():
    for n in range(1, 300):
        assert contamination.sketch_length(n) >= min(n, n - -(-n * 80 // 100) + 1)
        assert 1 <= contamination.sketch_share(n) <= contamination.sketch_length(n)


def _sit(customers, others, parent, key, number, discount=0.6, strength=1.0):
    """Tables of one dish, seated in the documented groups with the sampler's own draws."""
    tables = seated = min(customers, 1)
    step = 0
    while seated < customers:
        group = min(max(seated // 16, 1), customers - seated)
        new = (strength + discount * (others + tables)) * parent
        p = new / (new + seated - discount * tables)
        draw = pitman_yor._uniform(np.array([key], np.uint64), number, step)
        tables += int(pitman_yor._binomial(np.array([group]), np.array([p]), draw)[0])
        seated += group
        step += 1
    return tables


def _plain_model(near, burn_in, samples, d=0.6, s=1.0):
    """Whole restaurants in dictionaries: (P(w | u) averaged, counts, hashes of words); None stands for the end of a text."""
    pair, count, hashed = collections.Counter(), collections.Counter(), {None: pitman_yor.END}
    for i, t in corpus():
        w = [*WORD.findall(low(t)), None]
        for x in w[:-1]:
            if x not in hashed:
                raw = np.frombuffer(x.encode(), np.uint8)
                hashed[x] = text.words(raw, np.array([0, len(raw)])).hash[0]
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(w)
            pair.update(zip([None, *w[:-1]], w))
    number = {x: pitman_yor._numbers(near, np.array([h], np.uint64))[0] for x, h in hashed.items()}
    t, root, root_total = dict.fromkeys(pair, 1), dict.fromkeys(count, 1), len(count)
    found = []
    for k in range(-1, burn_in + samples):
        if k >= 0:
            t = {
                (u, w): _sit(n, tables[u] - t[u, w], p[w], pitman_yor._key(np.array([number[u]]), np.array([number[w]]))[0], k)
                for (u, w), n in pair.items()
            }
        tables, customers = collections.Counter(), collections.Counter()
        for (u, w), x in t.items():
            tables[u] += x
            customers[w] += x
        keys = {w: hashed[w] if number[w] >= 0 else np.array([number[w]]).view(np.uint64)[0] for w in count}
        root = {w: _sit(customers[w], root_total - root[w], 0.0, keys[w], 1000 + k) for w in count}
        root_total = sum(root.values())
        spare, scale = s + d * root_total, s + sum(customers.values())
        p = {w: (customers[w] - d * root[w]) / scale for w in count}
        if k >= burn_in:
            found.append((t, tables, p, spare / scale))

    def probability(u, w):
        one = [
            (pair[u, w] - d * t.get((u, w), 0) + (s + d * tables[u]) * p.get(w, unknown)) / (s + count[u])
            for t, tables, p, unknown in found
        ]
        return sum(one) / samples

    return probability, count


@pytest.mark.parametrize("near, pairs", [(1 << 20, 1 << 20), (40, 30), (0, 0)])
def test_language_model(spark, docs, near, pairs):
    """Whatever travels with the model or is joined, the score is that of whole restaurants."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    found = by_id(pitman_yor.score(docs, ~held, samples=2, burn_in=1, near=near, pairs=pairs))
    kept = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"), (~held).alias("_train"))
    model, _, _ = pitman_yor.train(kept, samples=1, burn_in=0, near=near)
    probability, count = _plain_model(model.near, 1, 2)
    assert len(model.near) <= near + 1
    total, kinds = sum(count.values()), len(count)
    for i, t in corpus():
        w = [*WORD.findall(low(t)), None]
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(count[x] > 0 for x in w), total)
        assert r.base_score == pytest.approx(sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in w))
        assert r.score == pytest.approx(sum(math.log10(probability(*x)) for x in zip([None, *w[:-1]], w)), rel=1e-5)
    for u in [None, *list(count)[:3], "never seen"]:
        assert sum(probability(u, w) for w in count) + probability(u, "never seen") == pytest.approx(1)


def test_binomial_quantiles():
    rng = np.random.default_rng(3)
    for n, p in ((1, 0.3), (12, 0.02), (40, 0.9), (4000, 0.2), (100_000, 1e-5)):
        drawn = pitman_yor._binomial(np.full(20_000, n), np.full(20_000, p), rng.random(20_000))
        assert drawn.min() >= 0 and drawn.max() <= n
        assert drawn.mean() == pytest.approx(n * p, rel=0.05) and drawn.var() == pytest.approx(n * p * (1 - p), rel=0.12)
    assert pitman_yor._binomial(np.array([5, 5]), np.array([1.0, 0.0]), np.array([0.5, 0.5])).tolist() == [5, 0]


def test_roots_are_seated_alike_in_slices(monkeypatch):
    rng = np.random.default_rng(5)
    customers, others, key = rng.integers(0, 90, 50), rng.integers(0, 9, 50), np.arange(50, dtype=np.uint64)
    whole = pitman_yor.seat(customers, others, np.zeros(50), 0.6, 1.0, key, 3)
    for size in (1, 7, 50, 1 << 16):
        monkeypatch.setattr(pitman_yor, "SLICE", size)
        assert pitman_yor._seat_roots(customers, others, 0.6, 1.0, key, 3).tolist() == whole.tolist()
    assert len(pitman_yor._seat_roots(customers[:0], others[:0], 0.6, 1.0, key[:0], 3)) == 0


def test_broadcasts_of_the_sweeps_are_destroyed(spark, docs, monkeypatch):
    gone = []
    monkeypatch.setattr(pitman_yor.Broadcast, "destroy", lambda self, blocking=False, end=pitman_yor.Broadcast.destroy: (gone.append(1), end(self, blocking)))
    kept = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"), F.lit(True).alias("_train"))
    pitman_yor.train(kept, samples=1, burn_in=1)
    assert len(gone) == 3


def test_seating_follows_the_restaurant_rule():
    n, zero = np.full(4000, 6), np.zeros(4000)
    tables = pitman_yor.seat(n, zero, np.ones(4000), 0.5, 1.0, np.arange(4000, dtype=np.uint64), 0)
    expected = 1.0
    dist = {1: 1.0}
    for seated in range(1, 6):
        step = collections.Counter()
        for t, p in dist.items():
            new = (1 + 0.5 * t) / (1 + 0.5 * t + seated - 0.5 * t)
            step[t + 1] += p * new
            step[t] += p * (1 - new)
        dist = step
    expected = sum(t * p for t, p in dist.items())
    assert tables.mean() == pytest.approx(expected, rel=0.03) and tables.min() >= 1 and tables.max() <= 6


def test_language_model_without_training(spark, docs, nothing):
    r = pitman_yor.score(docs.limit(3), F.lit(False)).collect()
    assert len(r) == 3 and all(x.n_known == 0 and x.train_tokens == 0 and x.base_score == 0 for x in r)
    assert pitman_yor.score(nothing, F.lit(True)).collect() == []


def test_language_identification(spark, nothing):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        lang, letters = rng.choice([("aa", "abcdeé"), ("bb", "pqrstü")])
        rows.append((i, " ".join("".join(rng.choices(letters, k=5)) for _ in range(rng.randint(1, 20))), lang, "clash"))
    rows += [(900, None, "aa", ""), (901, "12 34 !", "bb", ""), (902, "abc", None, ""), (903, "", None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    found = by_id(language.identify(df, F.col("doc_id") % 3 != 1))
    held = [i for i, _, k, _ in rows[:400] if i % 3 == 1]
    assert sum(found[i].lang_pred == rows[i][2] for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values()) and len(found) == len(rows)
    assert {found[i].lang_pred for i in (900, 901, 903)} == {"und"} and found[902].lang_pred == "aa"
    assert by_id(language.identify(df, F.lit(False)))[0].lang_pred == "und"
    assert language.identify(nothing, F.lit(True)).collect() == []


def test_temperature_lowers_overconfidence():
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 2, 500)
    scores = np.zeros((500, 2))
    scores[np.arange(500), np.where(rng.random(500) < 0.8, labels, 1 - labels)] = 10
    assert language.temperature(scores, labels) > 4


def greedy(word, first, later):
    n, pieces = 0, first
    while word:
        k = next((k for k in range(len(word), 0, -1) if word[:k] in pieces), 0)
        if not k:
            return 1
        word, pieces, n = word[k:], later, n + 1
    return n


def test_longest_match_automaton():
    rng = random.Random(6)
    for _ in range(200):
        first, later = ({"".join(rng.choices("abc", k=rng.randint(1, 4))).encode() for _ in range(rng.randint(1, 8))} for _ in range(2))
        for a, b in ((first, later), (first, first)):
            automaton = tokens.build(a, b)
            for _ in range(30):
                word = "".join(rng.choices("abc", k=rng.randint(0, 9))).encode()
                assert tokens.count(word, automaton) == greedy(word, a, b), (word, a, b)


def test_token_counts(docs, nothing):
    first = {bytes([k]) for k in range(256)} | {b"ab", b"abc", b" ", b" a"}
    found = by_id(tokens.token_counts(docs, first, prefix=b" "))
    for i, t in corpus():
        w = (t or "").encode().split()
        assert (found[i].n_words, found[i].n_tokens) == (len(w), sum(greedy(b" " + x, first, first) for x in w))
    assert tokens.token_counts(nothing, first).collect() == []


def test_url_rules(spark):
    rows = [
        "https://WWW.Example.com/en/1?x=/en/", "http://example.com/en/", "http://a.example.com/en", "http://example.com", "http://b.net/fr/x#y",
        "http://net/es/", "http://anet/es/", "ftp://x.org/", "no url", "", None, "http://://com/", "http://com:80/", "x://com?://y.net/es/",
    ] * 2
    df = spark.createDataFrame([(i % 20, u, "clash") for i, u in enumerate(rows)], "page_id long, url string, rule string")

    def expected(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (low(m[1]), m[2]) if m else ("", "")
        fits = [(len(h + p), v, h + p) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, "allow", None))
        return host, path, best[2], best[1]

    found = urls.judge(df, urls.rules_table(spark)).collect()
    assert sorted(repr(tuple(r)) for r in found) == sorted(repr((i % 20, *expected(u))) for i, u in enumerate(rows))
    assert {r.verdict for r in urls.judge(df, urls.rules_table(spark, ())).collect()} == {"allow"}


def test_surrogates(spark, nothing):
    value = "Mail a.b@c.de or +1 (612) 555-5827, card 4111 1111 1111 1111, 9.8.7.6. Mrs. Anna Schmidt met Herr Weber; a.b@c.de again."
    rows = [(1, value, "x"), (2, value, "y"), (3, "Nothing here", "z"), (4, None, "z"), (5, "", "z"), (6, "a.b@c.de", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, surrogate string")
    found = by_id(pii.pseudonymise(df, "key"))
    one = found[1].text
    assert found[2].text == one and found[3].text == "Nothing here" and found[4].text is None and found[5].text == ""
    assert [found[k].n_entities for k in range(1, 7)] == [7, 7, 0, 0, 0, 1]
    mail = found[6].text
    assert one.count(mail) == 2 and re.fullmatch(r"[a-z]\.[a-z]@\S+", mail)
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}", one)[0].replace(" ", "")
    assert sum(int(c) if k % 2 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(card)) % 10 == 0
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", one) and re.search(r"Mrs\. \w+ \w+ met Herr \w+;", one)
    for gone in ("a.b@", "612", "4111", "9.8.7.6", "Schmidt", "Weber"):
        assert gone not in one
    assert by_id(pii.pseudonymise(df, "other"))[6].text != mail
    assert pii.pseudonymise(nothing, "key").collect() == []


def test_contamination_at_the_threshold(spark):
    """Items that share shingles, documents that hold any share of them: the same pairs as sets give."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    common = [word() for _ in range(12)]
    items = [[word() for _ in range(rng.randint(5, 90))] for _ in range(40)] + [common + [word() for _ in range(k)] for k in (0, 1, 2, 3, 30)]
    texts = []
    for _ in range(150):
        held = rng.choice(items)
        begin = rng.randint(0, len(held) // 3)
        texts.append([word() for _ in range(rng.randint(0, 40))] + held[begin:] + [word() for _ in range(rng.randint(0, 400))])
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    table = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    grams = lambda t: {tuple(t[k : k + 5]) for k in range(len(t) - 4)}
    own = [grams(t) for t in items]
    want = {k: [i for i, g in enumerate(own) if 100 * len(g & grams(t)) >= 80 * len(g)] for k, t in enumerate(texts)}
    found = by_id(contamination.contamination(docs, table))
    assert {k: r.item_ids for k, r in found.items()} == want and 20 < sum(map(bool, want.values())) < 150


def test_repeated_slots_grow_with_the_rows(spark):
    """A filter folded to few bits misses no repeated text, and single texts do not fill it."""
    docs = spark.range(4000).select("id", F.when(F.col("id") < 20, F.col("id") % 10).otherwise(F.col("id")).cast("string").alias("text"))
    small = exact.repeated_slots(docs, most=1 << 12)
    keys = exact._keys(exact._digests(pa.array([str(k) for k in range(4000)])))
    hit = bloom.hits(small, keys)
    assert hit[:10].all() and hit.mean() < 0.2
    counted = exact.slot_counts(docs, exact.slots_for(docs))
    assert counted.agg(F.sum("n")).first()[0] == 8000 and counted.agg(F.max("slot")).first()[0] > 1 << 15


def test_surrogates_search(spark):
    """Entities that touch, texts that hold the mark, and clashing column names; the pieces are those of a plain search."""
    texts = [
        "(612) 555-5827a.b@c.de", "abc9.8.7.6 x", "é@ö.de", "a\uffffb", "a\uffffb c@d.de\uffff 123-45-6789", "x" * 5000 + "@y.zz", "Mr. Adam", "1.2.3.4 5.6.7.8",
        "_Mrs. Berg", "no.mail@ here, a+b@c-d.e.fr.", "12345678901234567890", "",
    ]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "_key long, text string, _pieces long")
    plain = "|".join(f"(?:{p})" for p in (pii.KINDS | {"email": r"[\p{L}0-9._%+-]+@[\p{L}0-9-]+(?:\.[\p{L}0-9-]+)+"}).values())
    want = df.select("_key", F.regexp_extract_all("text", F.lit(plain), F.lit(0)).alias("found"))
    cut = df.select("_key", "text", pii._pieces(F.col("text")).alias("cut")).join(want, "_key").collect()
    assert len(cut) == len(texts)
    for r in cut:
        assert "".join(r.cut) == r.text and [p for p in r.cut[1::2] if p] == r.found
    found = {r["_key"]: r for r in pii.pseudonymise(df, "key").collect()}
    assert len(found) == len(texts) and all(r["_pieces"] == k for k, r in found.items())
    assert found[3].text == texts[3] and found[4].n_entities == 2 and found[4].text.count("\uffff") == 2


def test_surrogates_stay_distinct(spark):
    entities = spark.range(3000).select(F.format_string("x%d@y.zz", F.col("id") % 100).alias("entity")).union(
        spark.range(900).select(F.format_string("%03d-11-2222", "id").alias("entity"))
    )
    found = pii.surrogates(entities, "key").collect()
    assert len(found) == 1000 == len({r.surrogate for r in found}) and not {r.surrogate for r in found} & {r.entity for r in found}


def test_surrogates_of_more_names_than_short_ones(spark):
    """There are 40,960 surrogates of a title and one name without further syllables."""
    letters = F.translate(F.format_string("%05d", F.col("id")), "0123456789", "abcdefghij")
    found = pii.surrogates(spark.range(60_000).select(F.concat(F.lit("Mr X"), letters).alias("entity")), "key").cache()
    total, distinct, names = found.agg(F.count("*"), F.countDistinct("surrogate"), F.count_if(F.col("surrogate").rlike(f"^(?:{pii.NAME})$"))).first()
    assert total == distinct == names == 60_000 and found.join(found.select(F.col("entity").alias("surrogate")), "surrogate").isEmpty()


def test_surrogates_of_spellings(spark):
    """Spellings of one entity get one surrogate in their own formats; other entities get others."""
    groups = {
        "weber": ["Mr Weber", "Mr. Weber", "Mr WEBER", "Herr Weber"], "anna keller": ["Dr. Anna Keller", "Frau Anna Keller"], "keller": ["Dr. Keller"],
        "mail": ["a.b@x.com", "A.b@x.com", "A.B@X.COM"], "phone": ["+1 612 555 5827", "+1 (612) 555-5827", "+1.612.555.5827"],
        "card": ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111"], "odd card": ["4111 1111 1111 1112"],
        "iban": ["DE44 5001 0517 5407 3249 31", "DE44500105175407324931"], "iban with letters": ["GB29 NWBK 6016 1331 9268 19"],
        "greek": ["Κύριος Νίκος Παπαδόπουλος", "Κύριος Παπαδόπουλος"], "ssn": ["123-45-6789"],
    }
    mentions = [(m,) for ms in groups.values() for m in ms]
    found = {r.entity: r.surrogate for r in pii.surrogates(spark.createDataFrame(mentions, "entity string"), "key").collect()}
    assert len(found) == len(mentions) and not set(found) & set(found.values())
    bare = lambda m: re.sub(r"^[^\W\d]+\.? | |-|[().+]", "", found[m]).lower()
    family = lambda m: found[m].split(" ")[-1].lower()
    assert len({family(m) for m in groups["weber"]}) == 1 and found["Mr WEBER"].split(" ")[1].isupper()
    assert {family(m) for m in groups["anna keller"] + groups["keller"]} == {family("Dr. Keller")} != {family("Mr Weber")}
    given = {found[m].split(" ")[1] for m in groups["anna keller"]}
    assert len(given) == 1 and any(g.startswith(n) for g in given for n in pii.NAMES["latin", "female"])
    for g in ("mail", "phone", "card", "iban"):
        assert len({bare(m) for m in groups[g]}) == 1, g
    assert family("Κύριος Παπαδόπουλος") == family("Κύριος Νίκος Παπαδόπουλος") and re.fullmatch(r"Κύριος [Ͱ-Ͽ ά-ώ]+", found["Κύριος Παπαδόπουλος"])
    shape = lambda x: re.sub("[A-Z]", "A", re.sub("[0-9]", "0", x))
    for m in groups["phone"] + groups["card"] + groups["iban"] + groups["iban with letters"] + groups["ssn"]:
        assert shape(m) == shape(found[m])
    assert found["A.b@x.com"][0].isupper() and found["DE44500105175407324931"][:2] == "DE" and found["+1 612 555 5827"][:3] == "+1 "
    luhn = lambda x: sum(int(c) if k % 2 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(re.sub("[^0-9]", "", x))) % 10
    assert luhn(found["4111 1111 1111 1111"]) == 0 and luhn(found["4111 1111 1111 1112"]) == 1


def test_surrogates_of_a_full_format(spark):
    """More numbers of one form than random draws could keep apart from each other and from the numbers themselves."""
    full = spark.range(300).select(F.lit("ssn").alias("kind"), F.format_string("%02d", F.col("id") % 100).alias("canon"), F.lit(None).cast("string").alias("gender"), F.lit("latin").alias("script"))
    found = pii.distinct_cores(full, "key", rounds=1).collect()
    assert len(found) == 100 == len({r.core for r in found}) and {len(r.core) for r in found} == {2}
    addresses = spark.range(50_000).select(F.concat_ws(".", F.lit("192"), F.lit("168"), F.floor(F.col("id") / 256).cast("string"), (F.col("id") % 256).cast("string")).alias("entity"))
    assert pii.surrogates(addresses, "key").filter(F.col("surrogate").rlike(f"^(?:{pii.IP})$")).select("surrogate").distinct().count() == 50_000


def test_clashing_names_and_repeated_weights(spark):
    names = ["_row", "_rows", "_s", "_i", "_start", "_in", "_range", "_place", "_sha", "_maybe", "_keep", "_digest", "_SHA_", "a.b", "_doc", "_id"]
    shape = "doc_id long, text string, source string, " + ", ".join(f"`{n}` int" for n in names)
    rows = [(k, f"text {k % 7}", "ab"[k % 2], *range(len(names))) for k in range(40)]
    docs = spark.createDataFrame(rows, shape)
    weights = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 2.0)], "source string, weight double")
    mixed = mixing.mix(docs, weights, block=2)
    assert mixed.columns == [*docs.columns, "block", "position"]
    assert sorted(tuple(r)[:-2] for r in mixed.collect()) == rows
    kept = exact.drop_duplicates(docs)
    assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == rows[-7:]
    near_kept = near.keep_first(docs, size=1)
    assert near_kept.columns == docs.columns and sorted(tuple(r) for r in near_kept.collect()) == rows[:7]


def test_what_is_no_letter(spark):
    rows = [(k, "some words here" if k % 2 else "andere wörter da", "en" if k % 2 else "de") for k in range(40)]
    odd = ["½", "²", "Ⅷ", "42 _ 7", "", None]
    docs = spark.createDataFrame(rows + [(100 + k, t, None) for k, t in enumerate(odd)], "doc_id long, text string, lang string")
    found = by_id(language.identify(docs, F.lit(True)))
    assert all(found[100 + k].lang_pred == "und" and found[100 + k].score == 0 for k in range(len(odd)))
    assert all(found[k].lang_pred == rows[k][2] for k in range(40))


def test_mixing_is_pfair(spark, nothing):
    rng = random.Random(8)
    sizes = {"a": 700, "b": 90, "c": 33, None: 5, "d": 1}
    rows = [(k, s) for k, s in enumerate(x for x, n in sizes.items() for _ in range(n))]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, s, 7) for i, s in rows], "doc_id long, source string, position int")
    weights = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 2.0), (None, 1.0)], "source string, weight double")
    found = mixing.mix(df, weights, block=4).collect()
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows)
    blocks = collections.defaultdict(set)
    members = collections.Counter()
    for r in found:
        blocks[r.position].add((r.source, r.block))
        members[r.source, r.block] += 1
    assert all(len(b) == 1 for b in blocks.values()) and sorted(blocks) == list(range(len(blocks)))
    assert all(n == 4 or b == (sizes[s] - 1) // 4 for (s, b), n in members.items())
    assert mixing.mix(nothing, weights).collect() == []


def flowed(sizes, weights):
    """What has flowed of each source after each slot, in exact fractions."""
    done, given = dict.fromkeys(sizes, Fraction(0)), []
    for _ in range(sum(sizes.values())):
        left = Fraction(1)
        while left:
            active = [s for s in sizes if done[s] < sizes[s]]
            total = sum(weights[s] for s in active)
            step = min(left, min((sizes[s] - done[s]) * total / weights[s] for s in active))
            for s in active:
                done[s] += step * weights[s] / total
            left -= step
        given.append(dict(done))
    return given


@pytest.mark.parametrize("case", ["many small", "unequal", "roots"])
def test_mixing_follows_the_given_weights(spark, case):
    rng = random.Random(5)
    small = [f"s{k:03d}" for k in range(120)]
    if case == "many small":
        sizes, weights = {"big": 500, **dict.fromkeys(small, 3)}, {"big": 0.9, **dict.fromkeys(small, 0.1 / 120)}
    elif case == "unequal":
        sizes, weights = {s: rng.randint(1, 20) for s in small[:50]}, {s: float(rng.choice((1, 1, 2, 30, 700))) for s in small}
    else:
        sizes = {"a": 300, "b": 200, "c": 31, "d": 17, "e": 11, "f": 6}
        weights = {s: math.sqrt(n) for s, n in zip(sizes, (300_000, 200_000, 1000, 300, 120, 40))}
    df = spark.createDataFrame([(f"{s}/{k}", s) for s, n in sizes.items() for k in range(n)], "doc_id string, source string")
    found = mixing.mix(df, spark.createDataFrame(list(weights.items()), "source string, weight double"), block=1).collect()
    order = sorted(found, key=lambda r: r.position)
    assert [r.position for r in order] == list(range(sum(sizes.values())))
    given = collections.Counter()
    for r, target in zip(order, flowed(sizes, {s: Fraction(w) for s, w in weights.items()})):
        assert r.block == given[r.source]
        given[r.source] += 1
        assert all(abs(given[s] - target[s]) < 1 + 1e-6 for s in sizes)


def test_mixing_of_many_sources(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), (F.col("id") % 3000).cast("string").alias("source"))
    weights = df.groupBy("source").agg(F.count("*").alias("weight"))
    assert sorted(r.position for r in mixing.mix(df, weights, block=1).collect()) == list(range(6000))


def test_word_hashes_do_not_depend_on_the_slice():
    import pyarrow as pa
    column = pa.array([t for _, t in corpus()], pa.string())
    for size in (2, 5):
        whole, parts = [], []
        for most, out in ((1 << 24, whole), (64, parts)):
            for _, _, raw, offsets in text.slices(column, most):
                hashes, bounds = text.shingles(text.words(raw, offsets), size)
                out += [hashes[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        assert whole == parts


def test_rows_apart_from_keys_do_not_move(spark):
    rows = spark.range(3000).select(F.when(F.col("id") > 9, F.col("id")).alias("a"), F.lit("x").alias("_maybe"))
    keys = spark.range(500, 600).select(F.xxhash64("id").alias("k"))
    alone, others = bloom.apart(rows, F.xxhash64("a"), keys, "k")
    assert alone.columns == others.columns == rows.columns and alone.count() + others.count() == 3000
    assert {r["a"] for r in others.collect()} >= set(range(500, 600)) and others.count() < 150
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert bloom.apart(rows, F.xxhash64("a"), keys.limit(0), "k")[1].isEmpty()


def test_clean_documents_pass_without_an_exchange(spark):
    item = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, f"a b {item} c"), (1, "a b c"), (None, item), (None, None), (2, "a b c")], "doc_id int, text string")
    items = spark.createDataFrame([(1, item)], "item_id int, text string")
    left = contamination.drop_contaminated(docs, items)
    assert sorted(left.collect(), key=str) == sorted([(1, "a b c"), (None, None), (2, "a b c")], key=str)
    union = left._jdf.queryExecution().optimizedPlan()
    assert union.nodeName() == "Union" and "Join" not in union.children().apply(0).toString()


def test_slices_hold_a_quarter_of_a_megabyte():
    column = pa.array(["x" * 100_000] * 9 + ["y" * 600_000, None])
    sizes = [(j - i, len(raw)) for i, j, raw, _ in text.slices(column)]
    assert [n for n, _ in sizes] == [2, 2, 2, 2, 1, 1, 1] and max(b for n, b in sizes if n > 1) <= 1 << 18


def test_pairs_of_scores_are_gone_when_results_are_read(spark):
    few = spark.createDataFrame([(1, "a b a b"), (2, "a b c"), (3, None)], "doc_id int, text string")
    scored = pitman_yor.score(few, F.col("doc_id") != 2, samples=1, burn_in=0, near=2)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and scored.count() == 3
    values = {r["doc_id"]: r for r in scored.collect()}
    assert [values[k]["n_tokens"] for k in (1, 2, 3)] == [5, 4, 1] and values[2]["n_known"] == 3


@pytest.mark.parametrize("near", [0, 4, 1 << 10])
def test_near_pairs_are_one_row_a_bucket(spark, near, monkeypatch):
    """Counts are those of plain dictionaries, whatever is near and however small the pieces are."""
    monkeypatch.setattr(text, "SLICE_BYTES", 16)
    lines = [("a b a b c", True), ("a b a b c", True), ("c d", False), ("e c", True), ("", True), ("d e c", False), ("zz yy", False)]
    docs = spark.createDataFrame(lines, "_text string, _train boolean").repartition(3)
    tokens = {x: text.words(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x)])).hash[0] for x in "a b c d e zz yy".split()}
    tokens[None] = pitman_yor.END
    known = np.sort(np.array([tokens[x] for x in (None, "a", "b", "c", "d")[: max(near, 1)]], np.uint64))
    counted = pitman_yor.pair_counts(docs, spark.sparkContext.broadcast(known), 3).collect()
    assert len(counted) == len({r["bucket"] for r in counted}) and {r["bucket"] for r in counted} <= {0, 1, 2}
    inside, outside = collections.Counter(), set()
    for line, train in lines:
        words = [None, *line.split(), None]
        (inside.update if train else outside.update)(zip(words, words[1:]))
    number = {x: int(pitman_yor._numbers(known, np.array([h], np.uint64))[0]) for x, h in tokens.items()}
    expected = {(number[u], number[w]): n for (u, w), n in inside.items() if n > 1 or (u, w) in outside}
    found = {divmod(pair, len(known)): n for r in counted for pair, n in zip(r["pair"], r["n"])}
    found |= {(u, w): n for r in counted for u, w, n in zip(r["far_u"], r["far_w"], r["far_n"])}
    assert found == expected
    assert all(r["pair"] == sorted(set(r["pair"])) for r in counted)


def test_hashes_are_found_by_their_leading_bits():
    rng = np.random.default_rng(8)
    hashes = text.mix(np.arange(1000, dtype=np.uint64))
    crowded = np.concatenate([np.arange(60, dtype=np.uint64), [np.uint64(2**64 - 1)]])
    for values in (hashes[:0], hashes[:1], hashes[:700], crowded):
        values = np.sort(values)
        keys = np.concatenate([hashes, crowded, rng.permutation(values)])
        at, found = pitman_yor._places(values, pitman_yor._starts(values), keys)
        assert found.tolist() == np.isin(keys, values).tolist() and (values[at[found]] == keys[found]).all()
