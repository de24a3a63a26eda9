"""The training-data operators on small and awkward inputs, against plain Python."""

import os
import random
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import oracle  # noqa: E402
from fieldspark.llm import leak, mix, queries, split, tokens, topn  # noqa: E402


# ---------------------------------------------------------------- 2
@pytest.mark.parametrize("heavy", [10**6, 50, 1])
def test_top_n_against_plain_python(spark, heavy):
    rnd = random.Random(heavy)
    rows = [(rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice([None, *range(150)]), i, rnd.choice([None, float("nan"), float("inf"), -1.0, 0.0, 0.5, 0.5, 2.0]), rnd.choice([None, 1, 2]), "clash") for i in range(500)]
    rows += [(9, 1, 1000, 1.0, 1, "x"), (9, 1, 1001, 1.0, 1, "x"), (9, 2, 1002, None, 1, "x"), (9, 2, 1003, 3.0, None, "x")]
    df = spark.createDataFrame(rows, "run_id bigint, draw_no bigint, rating_id bigint, adj_net double, net_rank int, pos string")
    items = {}
    for g, c, i, s, r, _ in sorted(rows, key=lambda x: x[2]):
        if g is not None:
            k = (g, c if c is not None else ("own", i))
            first, val = items.get(k, (i, None))
            items[k] = (first, val or ((s, r) if s is not None and s == s else None))
    want = set()
    for g in {k[0] for k in items}:
        best = sorted((-v[0], v[1] is None, v[1] or 0, i) for (h, _), (i, v) in items.items() if h == g and v)[:5]
        want |= {(g, p + 1, b[3]) for p, b in enumerate(best)}
    got = topn.top_n(topn.one_per_copy(df, "run_id", "draw_no", "rating_id", "adj_net", "net_rank"), 5, heavy)
    assert {tuple(r) for r in got.collect()} == want
    assert {tuple(r) for r in topn.top_items(df, "run_id", "draw_no", "rating_id", "adj_net", "net_rank", 5, heavy).collect()} == want
    assert topn.top_n(topn.one_per_copy(df.limit(0), "run_id", "draw_no", "rating_id", "adj_net", "net_rank"), 5).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, data, name):
    oracle.assert_same(queries.QUERIES[name](spark, data), oracle.connect(data), queries.SQL[name])


# ---------------------------------------------------------------- 8
WORDS = [f"w{i}" for i in range(60)]


def passage(rnd, n):
    return [rnd.choice(WORDS) + str(rnd.randrange(10)) for _ in range(n)]


def runs(item, doc, n=12):
    grams = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)}
    return any(tuple(doc[i : i + n]) in grams for i in range(len(doc) - n + 1))


def test_leaks_against_plain_python(spark):
    rnd = random.Random(3)
    items = [(i, passage(rnd, rnd.choice([5, 12, 30, 50]))) for i in range(20)]
    docs = []
    for d in range(120):
        w = passage(rnd, rnd.randrange(0, 60))
        for _ in range(rnd.randrange(3)):
            t = rnd.choice(items)[1]
            a, n = rnd.randrange(len(t)), rnd.choice([11, 12, 13, 25])
            w[rnd.randrange(len(w) + 1) : 0] = t[a : a + n]
        docs.append((d, w))
    want = {(d, i) for d, w in docs for i, t in items if runs(t, w)}
    D = spark.createDataFrame([(d, " ".join(w), "clash") for d, w in docs] + [(500, None, ""), (501, "", "")], "doc_id bigint, text string, item_id string")
    items_df = spark.createDataFrame([(i, " ".join(t)) for i, t in items] + [(99, None), (98, "")], "item_id bigint, text string")
    seen = []
    for block in (10**6, 60):  # one pass, and one pass per few items
        old, leak.BLOCK_WORDS = leak.BLOCK_WORDS, block
        try:
            found = leak.leaked_windows(D, items_df)
            seen.append(sorted(map(tuple, found.collect())))
            got = found.where("exact").select("doc_id", "item_id").distinct().collect()
        finally:
            leak.BLOCK_WORDS = old
        assert {tuple(r) for r in got} == want and want
    assert seen[0] == seen[1]  # blocks change neither finds nor similarities
    assert leak.leaked_windows(D, items_df.limit(0)).count() == 0
    assert leak.leaked_windows(D.limit(0), items_df).count() == 0


@pytest.mark.parametrize(
    "change",
    [
        str.upper,
        lambda t: t.replace(" ", "&nbsp;&ndash; "),
        lambda t: "<b>" + t.replace(" ", '</b>\n<span class="q">') + "</span>",
        lambda t: re.sub(r"(\w)(\w)", "\\1\u200b\\2", t),
        lambda t: t.replace("a", "\u00ada"),
        lambda t: t.replace("é", "e\u0301").replace("1", "１"),
        lambda t: t.replace("é", "&eacute;").replace(" ", "... "),
        lambda t: "> " + t.replace(" ", "\r\n> "),
        lambda t: "__" + t.replace(" ", "_"),
    ],
)
def test_spelling_of_a_passage_makes_no_difference(change):
    item = "el árbitro café marcó la jugada 12 después del balón suelto y avanzó 31 yardas más allá".replace("á", "á")
    own = leak.Items([7], [item], 12, 2)
    assert {r[:2] for r in leak.scan(own, [1, 2], ["nada que ver con esto", "prefijo " + change(item) + " sufijo"], 0.8)} == {(2, 7)}


def test_fingerprints_within_the_radius_are_always_found():
    rng = np.random.default_rng(0)
    own = leak.Items([1], [" ".join(f"x{i}" for i in range(200))], 12, 2)
    base = own.prints[rng.integers(0, len(own.prints), 300)]
    for flips in (0, 1, 2, 3):
        probe = base.copy()
        for k in range(len(probe)):
            for bit in rng.choice(64, flips, replace=False):
                probe[k] ^= np.uint64(1 << int(bit))
        left, right = own.candidates(probe)
        brute = {(a, b) for a in range(len(probe)) for b in np.flatnonzero(np.bitwise_count(own.prints ^ probe[a]) <= 2).tolist()}
        assert set(zip(left.tolist(), right.tolist(), strict=True)) == brute
        assert flips > 2 or {a for a, _ in brute} == set(range(len(probe)))


def test_fingerprints_with_slack_are_always_found():
    rng = np.random.default_rng(4)
    own = leak.Prints(rng.integers(0, 1 << 63, 200, dtype=np.uint64), leak.ITEM_RADIUS, slack=1)
    assert len(own.sorted) == 4
    for flips in (0, 5, 7, 9):
        probe = own.prints.copy()
        for k in range(len(probe)):
            for bit in rng.choice(64, flips, replace=False):
                probe[k] ^= np.uint64(1 << int(bit))
        left, right = own.candidates(probe)
        got = set(zip(left.tolist(), right.tolist(), strict=True))
        assert got == {(a, b) for a in range(len(probe)) for b in np.flatnonzero(np.bitwise_count(own.prints ^ probe[a]) <= 7).tolist()}


def test_edited_items_are_recalled(data):
    """Planted edits: of all copies whose weighted similarity is at least 0.8 (by brute force over all places), at least 0.9 are found."""
    import pyarrow.parquet as pq

    rnd = random.Random(11)
    t = pq.read_table(f"{data}/eval_items.parquet", columns=["item_id", "text"]).to_pydict()
    rows = [(i, x) for i, x in zip(t["item_id"], t["text"], strict=True) if x]
    own = leak.Items([i for i, _ in rows], [x for _, x in rows], leak.WORDS, leak.RADIUS)
    hit = asked = 0
    for k, (ident, _) in enumerate(rows):
        for edits in (1, 2, 3):
            w = [x.decode() for x in own.words[k]]
            for _ in range(edits):
                p = rnd.randrange(len(w))
                kind = rnd.choice("sid")
                w[p : p + (kind != "i")] = [] if kind == "d" else [f"zq{rnd.randrange(10**6)}"]
            doc = [f"vx{rnd.randrange(10**6)}" for _ in range(30)] + w + [f"vx{rnd.randrange(10**6)}" for _ in range(30)]
            h, _, _ = leak.word_hashes(" ".join(doc).encode())
            n = len(own.words[k])
            brute = max(own.similarity(k, leak.shingle_hashes(h[a : a + n])) for a in range(0, len(h) - n + 1))
            if brute >= leak.SIMILARITY:
                asked += 1
                hit += any(r[1] == ident and r[5] == "item" for r in leak.scan(own, [1], [" ".join(doc)], leak.SIMILARITY))
    assert asked > 150 and hit >= 0.9 * asked, (hit, asked)


def test_similarities_equal_sets_of_words():
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice("abcd") for _ in range(rnd.randrange(14, 40))) for _ in range(12)]
    own = leak.Items(list(range(12)), texts, 12, 2)
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    sets = [grams(t.split()) for t in texts]
    weight = lambda g, k: np.log1p(12 / sum(g in s for s in sets)) if g in sets[k] else np.log1p(12)
    for _ in range(200):
        w, v = [rnd.choice("abcd") for _ in range(12)], rnd.randrange(len(own.item))
        k, p = int(own.item[v]), int(own.pos[v])
        h, _, _ = leak.word_hashes(" ".join(w).encode())
        for theirs, got in ((sets[k], own.similarity(k, leak.shingle_hashes(h))), (grams(texts[k].split()[p : p + 12]), own.window_similarities(leak.shingle_hashes(h), np.array([0]), np.array([v]))[0][0])):
            inside = lambda g: weight(g, k) if g in theirs else np.log1p(12)  # noqa: B023, E731
            assert got == pytest.approx(sum(map(inside, grams(w) & theirs)) / sum(map(inside, grams(w) | theirs)))


def test_long_tags_are_no_words():
    assert leak.plain("a<b " + "x" * 5000 + ">c").split() == ["a", "c"]


def test_simhash_is_a_majority():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    got = leak.window_simhash(w, 12)
    bits = np.unpackbits(w.view(np.uint8).reshape(-1, 8), axis=1)
    want = np.array([np.packbits(bits[i : i + 12].sum(0) > 6).view(np.uint64)[0] for i in range(29)])
    assert (got == want).all()
    assert len(leak.window_simhash(w[:11], 12)) == 0
    long = rng.integers(0, 1 << 63, 40_000, dtype=np.uint64)
    for z, prints in leak.sized_simhashes(long, [12, 45, 89]).items():
        assert (prints == leak.window_simhash(long, z)).all() and len(prints) == len(long) - z + 1


# ---------------------------------------------------------------- 9
def mixing(spark, docs, mixes, **kw):
    d = spark.createDataFrame([(i, s, t, "clash") for i, (s, t) in enumerate(docs)], "doc_id bigint, source string, tokens bigint, round string")
    m = spark.createDataFrame(mixes, "mix_id string, source string, target_share double, max_repeats int")
    draws, planned = mix.mix(d, m, **kw)
    drawn = mix.drawn_documents(draws)
    return drawn, {(r.mix_id, r.source): r for r in mix.share_report(drawn, planned).collect()}


def test_mix_reaches_shares_within_caps(spark):
    rnd = random.Random(0)
    docs = [("Big One", rnd.randrange(1, 400)) for _ in range(3000)] + [("small", rnd.randrange(1, 400)) for _ in range(150)] + [("SMALL ", 200)] * 5 + [(None, 9), ("other", 0), ("other", 50)]
    mixes = [("m", "big_one", 0.6, None), ("m", "small", 0.3, 3), ("m", "absent", 0.4, 1), ("m", "other", None, 1), ("n", "small", 2.0, None), ("n", "big-one", 2.0, None), (None, "small", 1.0, 1), ("z", "absent", 1.0, 1)]
    drawn, rep = mixing(spark, docs, mixes)
    small, big = rep["m", "small"], rep["m", "bigone"]
    assert small.reached_share == pytest.approx(1 / 3, abs=0.01) and big.reached_share == pytest.approx(2 / 3, abs=0.01)
    assert small.most_used <= 3 and small.drawn_tokens > 2.9 * small.stock_tokens
    assert rep["m", "absent"].reached_share == 0 and rep["m", "other"].drawn_tokens == 0 and rep["z", "absent"].drawn_tokens == 0
    assert rep["n", "bigone"].n_docs == 3000 and rep["n", "small"].reached_share == pytest.approx(0.5, abs=0.01)
    assert drawn.where("n_used < 1").count() == 0 and drawn.groupBy("mix_id", "doc_id").count().where("count > 1").count() == 0


def test_mix_every_stretch_holds_the_shares(spark):
    docs = [("a", 100)] * 600 + [("b", 100)] * 600
    d = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(docs)], "doc_id bigint, source string, tokens bigint")
    m = spark.createDataFrame([("m", "a", 0.25, None), ("m", "b", 0.75, None)], "mix_id string, source string, target_share double, max_repeats int")
    draws, _ = mix.mix(d, m)
    slots = sorted((r.slot, r.source) for r in draws.select("slot", "source").distinct().collect())
    for a in range(0, len(slots) - 64, 64):
        assert sum(s == "a" for _, s in slots[a : a + 64]) == pytest.approx(16, abs=3)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_shares_are_reached_to_half_a_document(spark, data, sf):
    folder = os.path.join(os.path.dirname(data), sf)
    rows = queries.p9_shares(spark, folder).collect()
    for r in rows:
        assert abs(r.drawn_tokens - r.quota_tokens) <= r.largest_doc / 2 + 1
        assert r.max_repeats is None or r.most_used <= r.max_repeats
    assert sum(r.drawn_tokens > 0 for r in rows) > 15


def test_slots_do_not_depend_on_the_smallest_source(spark):
    docs = [("a", 1000)] * 3000 + [("b", 1)]
    d = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(docs)], "doc_id bigint, source string, tokens bigint")
    m = spark.createDataFrame([("m", "a", 0.999999, None), ("m", "b", 0.000001, None)], "mix_id string, source string, target_share double, max_repeats int")
    draws, planned = mix.mix(d, m)
    assert planned.agg(F.max("slots")).first()[0] == -(-3_000_003 // mix.SLOT_TOKENS)
    got = {r.source: r for r in mix.share_report(mix.drawn_documents(draws), planned).collect()}
    assert got["a"].drawn_tokens == 3_000_000 and got["b"].drawn_tokens == 3


def test_mix_total_and_empty(spark):
    _, rep = mixing(spark, [("a", 10)] * 1000, [("m", "a", 1.0, 2)], total_tokens=5000)
    assert rep["m", "a"].drawn_tokens == pytest.approx(5000, rel=0.05)
    _, none = mixing(spark, [], [("m", "a", 1.0, 2)])
    assert none["m", "a"].drawn_tokens == 0


# ---------------------------------------------------------------- 10 and tokens
@pytest.fixture(scope="module")
def counter():
    return tokens.counter(tokens.default_path())


TEXTS = ["", "One. Two.\n\nThree!", "x" * 9000, "é" * 3000, " \n" * 2000, "日本語。" * 800, "a.b.c." * 900, "word " * 3000, "Don't  stop\u00a0now…\u3000５ ok\x1c\x85 " * 300, "\r\n".join(f"Line {i}: some words, 12 of 13." for i in range(900))]


def test_counts_equal_the_tokenizer(counter):
    for t in TEXTS:
        assert counter.tokens(t) == len(counter.encoding.encode_ordinary(t))
        assert "".join(counter.pre_tokens(t)) == t


@pytest.mark.parametrize("limit,overlap", [(1200, 100), (40, 0), (40, 39), (7, 3)])
def test_pieces_cover_the_text(counter, limit, overlap):
    for k, t in enumerate(TEXTS):
        if not t:
            continue
        pieces = split.split_batch([k], [t], counter, limit, overlap, True)
        assert pieces[0][6] == 0 and pieces[-1][7] == len(t) and all(p[5] <= limit and p[8] == t[p[6] : p[7]] for p in pieces)
        assert [p[1] for p in pieces] == list(range(len(pieces))) and all(p[2] == len(pieces) for p in pieces)
        for a, b in zip(pieces, pieces[1:], strict=False):
            assert b[3] == max(0, a[4] - overlap) and b[6] <= a[7] and b[4] > a[4]


def test_cuts_at_natural_boundaries(counter):
    t = " ".join(f"The runner number {i} gained {i % 9} yards on the play." for i in range(600))
    pieces = split.split_batch([1], [t], counter, 200, 20, True)
    assert len(pieces) > 20 and all(p[8].endswith(".") for p in pieces)
    enc = counter.encoding.encode_ordinary
    for a, b in zip(pieces, pieces[1:], strict=False):
        assert a[8].endswith(b[8][: a[7] - b[6]]) and a[4] - b[3] == 20 and len(enc(b[8])) <= 200


def test_doubling_equals_stepping():
    rng = np.random.default_rng(2)
    n = 500
    nxt = np.minimum(np.arange(n) + rng.integers(1, 9, n), n - 1)
    on, i = {0}, 0
    while nxt[i] != i:
        i = int(nxt[i])
        on.add(i)
    assert set(np.flatnonzero(split.all_cuts(nxt, np.array([0])))) == on


def test_split_frame(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(90, None, ""), (None, "short", "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    got = split.split_documents(df).collect()
    assert {r.doc_id for r in got if r.n_pieces > 1} == {i for i, t in enumerate(TEXTS) if tokens.counter(tokens.default_path()).tokens(t) > 1200}
    assert [(r.n_pieces, r.n_tokens, r.text) for r in got if r.doc_id == 90] == [(1, 0, "")]
    assert [r.text for r in got if r.doc_id is None] == ["short"]
    assert split.split_documents(df.limit(0)).count() == 0


# ---------------------------------------------------------------- all queries
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run_whole(spark, data, name):
    df = queries.QUERIES[name](spark, data)
    rows = df.collect()
    if name.endswith("_found"):
        assert len(set(rows)) == len(rows)
    if name == "p9_shares":
        assert all(r.max_repeats is None or r.most_used <= r.max_repeats for r in rows)


def test_found_leaks_equal_plain_search(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("text is not null").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{data}/eval_items.parquet").select("item_id", "text").collect()
    cut = lambda t: re.findall(r"[^\W_]+", leak.plain(t).lower())
    windows = {}
    for r in items:
        w = cut(r.text)
        for i in range(len(w) - 11):
            windows.setdefault(tuple(w[i : i + 12]), set()).add(r.item_id)
    want = set()
    for r in docs:
        w = cut(r.text)
        for i in range(len(w) - 11):
            want |= {(r.doc_id, j) for j in windows.get(tuple(w[i : i + 12]), ())}
    assert {tuple(r) for r in queries.p8_found(spark, data).collect()} == want


def test_found_oversized_equal_the_tokenizer(spark, data, counter):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("text is not null").select("doc_id", "text").collect()
    want = {r.doc_id for r in docs if len(counter.encoding.encode_ordinary(r.text)) > 1200}
    assert {r[0] for r in queries.p10_found(spark, data).collect()} == want
    pieces = queries.p10_pieces(spark, data)
    assert pieces.where(F.col("n_tokens") > 1200).count() == 0


def test_short_texts_have_sizes(spark):
    texts = ["First and 10 at the 35", "año " * 20, "x" * 1200, "word " * 2000, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    c = tokens.counter(tokens.default_path())
    got = {r.doc_id: r for r in split.split_documents(df).where("piece_no = 0").collect()}
    for k, t in enumerate(texts):
        if got[k].n_pieces == 1:
            assert got[k].n_tokens == got[k].end_token == c.tokens(t)
    assert got[3].n_pieces > 1 and sum(r.n_pieces == 1 for r in got.values()) == 4
