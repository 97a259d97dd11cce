"""Text operators against plain searches, and on awkward tables."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import chunk_dedup, crf, decontaminate, near_duplicates, pii, quality, sentencepiece, suffix_dedup, token_counts, topk_search, url_rules
from panelkit.llm.vocab import MARK, NORMAL, read_pieces


def plain_repeats(texts, width):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each text, by counting every window."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + width] for b in raw for p in range(len(b) - width + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if seen[b[p : p + width]] > 1:
                gone[p : p + width] = b"\1" * width
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        spans = sum(1 for k, y in enumerate(gone) if y and (k == 0 or not gone[k - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_is_exact(spark):
    rng = np.random.default_rng(3)
    base = ["".join(rng.choice(list("abc def"), 300)) for _ in range(6)]
    texts = [*base, base[0], base[1][:150] + "X" + base[2][100:], "q" * 200, base[3][50:120] * 3, None, "", base[4][:60], base[0][10:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup_digest(docs, width=60, gram=20, batches=3, passage=40).collect()}
    assert [got[k] for k in range(len(texts))] == plain_repeats(texts, 60)


def test_suffix_dedup_on_the_table(spark, documents):
    some = documents.head(80)
    got = suffix_dedup.dedup_digest(spark.createDataFrame(some)).toPandas().set_index("doc_id")
    want = plain_repeats(some.text, 400)
    assert [tuple(got.loc[i, ["n_bytes", "n_removed", "n_spans", "kept_sha256"]]) for i in some.doc_id] == want


def test_shorter_passages_are_counted(spark, documents):
    """Every repeated string of PASSAGE bytes is met; only bytes in repeated strings of GRAM bytes are counted."""
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(3, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(51) for _ in range(60)]
    texts = [f"{text(30)} {p} {text(40)}" for p in passages for _ in range(2)] + [text(121) for _ in range(20)] + documents.text.head(60).tolist()
    texts += [None, "", "z" * 500, passages[0] * 2]
    got = suffix_dedup.dedup_digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: r for r in got.collect()}
    assert min(map(len, passages)) >= suffix_dedup.PASSAGE - 50
    wide, narrow = plain_repeats(texts, suffix_dedup.PASSAGE), plain_repeats(texts, suffix_dedup.GRAM)
    for k in range(len(texts)):
        assert got[k].n_removed <= got[k].n_repeated <= narrow[k][1], k
        assert got[k].n_repeated >= suffix_dedup.GRAM * (wide[k][1] > 0), k
    assert all(got[k].n_repeated >= suffix_dedup.GRAM for k in range(120) if len(passages[k // 2]) >= suffix_dedup.PASSAGE)
    assert all(got[k].n_repeated == 0 for k in range(120, 140))


def test_long_texts_are_cut_without_loss():
    text = np.frombuffer(np.random.default_rng(1).bytes(700_000), np.uint8)
    whole = chunk_dedup.boundaries(text, np.array([0, len(text)]))
    shifted = chunk_dedup.boundaries(np.concatenate([text[:5], text]), np.array([0, len(text) + 5]))
    assert len(set(whole + 5) & set(shifted)) > 0.99 * len(whole)  # an insertion moves cuts near it only


def test_chunk_dedup_finds_shared_passages(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(120)
    rows = [(k, text(80) + passage + text(60 + k)) for k in range(5)] + [(k, text(200)) for k in range(5, 15)]
    got = {r.doc_id: r for r in chunk_dedup.chunk_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k].n_shared > 0.6 * len(passage) for k in range(5))
    assert got[0].n_removed == 0 and all(got[k].n_removed == got[k].n_shared for k in range(1, 5))
    assert all(got[k].n_shared == 0 for k in range(5, 15))


def test_chunk_dedup_finds_every_passage_of_51_words(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(3, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(51) for _ in range(100)]
    rows = [(2 * k + half, f"{text(40)} {p} {text(40)}") for k, p in enumerate(passages) for half in range(2)] + [(k, text(131)) for k in range(200, 230)]
    got = {r.doc_id: r for r in chunk_dedup.chunk_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[2 * k].n_shared > 0 and got[2 * k + 1].n_removed > 0 for k in range(100))
    assert sum(got[2 * k + 1].n_removed for k in range(100)) > 0.65 * sum(map(len, passages))
    assert all(got[k].n_shared == 0 for k in range(200, 230))


def plain_windows(docs, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    sets = defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(len(w), window)
        for k in range(len(w) - n + 1 if n else 0):
            sets[n, tuple(w[k : k + n])].add(i)
    out = []
    for t in docs:
        w, hit, found = words(t), set(), set()
        for n in {n for n, _ in sets}:
            for k in range(len(w) - n + 1):
                if own := sets.get((n, tuple(w[k : k + n]))):
                    hit |= set(range(k, k + n))
                    found |= own
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_decontamination_matches_plain_windows(spark, block):
    items = [(1, "One two Three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "short item"), (3, None), (4, "--"), (5, "uno")]
    docs = ["x ONE two three four five six seven eight nine ten eleven twelve thirteen y", "a short item, short item", None, "", "uno", "one two three", "Ünï short  item2"]
    left = spark.createDataFrame([(k, t, "c") for k, t in enumerate(docs)], "doc_id long, text string, hits string")
    right = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(left, right, block_bytes=block).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, list(r["items"])) for r in got] == plain_windows(docs, items)
    assert got[0].longest == 13 and got[0].longest_at == 1


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_items_without_an_id_hit_words(spark, block):
    items = [(None, "a nameless item of six words"), (7, "named item"), (None, "other"), (None, None)]
    docs = ["this is a nameless item of six words", "a named item", "other named item", "nothing"]
    left, right = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(left, right, block_bytes=block).orderBy("doc_id").collect()
    assert [(r.n_hit, list(r["items"]), r.contaminated) for r in got] == [(6, [], True), (2, [7], True), (3, [7], True), (0, [], False)]
    assert got[0].longest == 6 and got[0].longest_item is None


def test_a_plan_holds_one_benchmark_block(spark):
    items = spark.createDataFrame([(k, f"item of number {k} here") for k in range(40)], "item_id long, text string")
    docs = spark.createDataFrame([(0, "item of number 7 here"), (1, "item of number 31 here and")], "doc_id long, text string")
    found = decontaminate.find_contamination(docs, items, block_bytes=200)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert [list(r["items"]) for r in found.orderBy("doc_id").collect()] == [[7], [31]]


def test_frequent_words_are_matched_in_parts(monkeypatch):
    """A word repeated on both sides pairs every place with every suffix: the parts give what one piece gives."""
    texts = ["no " * 60 + "yes", "yes no no no no", "no " * 12, "x " + "no " * 20]
    items = [(1, "no " * 30), (2, "no no"), (1, "x no no"), (3, "no " * 14 + "yes")]
    tests = decontaminate.Suffixes.build([i for i, _ in items], [t for _, t in items], 13)
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)])
    whole = decontaminate._scan_shard(data, offsets, tests)
    plain = decontaminate.find_matches
    monkeypatch.setattr(decontaminate, "find_matches", lambda *a: plain(*a, most=7))
    assert decontaminate._scan_shard(data, offsets, tests) == whole
    got = [(r["n_words"], sum(x["end"] - x["lo"] for x in r["hits"]), r["items"]) for r in whole]
    assert got == plain_windows(texts, items)
    assert [r["longest"] for r in whole] == [30, 4, 12, 20]


def test_base_patterns_are_the_plain_ones():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    n = lambda s: sum(c in "0123456789" for c in s)

    def plain(t):
        out = [("email", *m.span()) for m in email.finditer(t)]
        out += [("ip", *m.span()) for m in ip.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
        out += [("card", *m.span()) for m in card.finditer(t) if 14 <= n(m.group()) <= 19 and pii.luhn(re.sub("[^0-9]", "", m.group()))]
        out += [("phone", *m.span()) for m in phone.finditer(t) if 10 <= n(m.group()) <= 15]
        return pii.sort_spans(out)

    rng = np.random.default_rng(0)
    alphabet = list("ab.@@+-_ ()1234567890..  é") + ["4111111111111111", "+1 (555) 555-0100", "10.2.33.4", "x@y.zz"]
    for _ in range(3000):
        t = "".join(rng.choice(alphabet, 25))
        assert pii.base_spans(t) == plain(t), t


def test_crf_on_held_out_rows():
    finder = pii.Finder(pii.default_model())
    rows = pii.training_table(300, seed=77)
    got = finder.spans([r["text"] for r in rows])
    hit = sum(s in spans for r, (_, spans) in zip(rows, got, strict=True) for s in r["spans"])
    assert hit >= 0.93 * sum(len(r["spans"]) for r in rows)
    assert all(set(base) <= set(spans) for base, spans in got)


def test_addresses_without_digits_are_found(monkeypatch):
    finder = pii.Finder(pii.default_model())
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("aeiou")) + rng.choice(list("bdlmnrst")) for _ in range(rng.integers(2, 5)))
    for form in ("{}.{} @ {} . com", "{}_{}@{} . org", "{}.{} at {} . com"):
        rows = []
        for _ in range(100):
            front, address = f"{word()} {word()} you can reach me at ", form.format(word(), word(), word())
            rows.append((front + address + f" any time {word()}", ("email", len(front), len(front) + len(address))))
        got = finder.spans([t for t, _ in rows])
        with monkeypatch.context() as whole:
            whole.setattr(pii, "neighbourhoods", lambda text: [(0, len(text))])
            assert got == finder.spans([t for t, _ in rows]), form
        # The field itself reads the form with " at " less surely than the others.
        assert sum(s in spans for (_, s), (_, spans) in zip(rows, got, strict=True)) >= (70 if " at " in form else 93), form


def test_spans_in_long_runs_of_numbers_do_not_depend_on_their_place():
    finder = pii.Finder(pii.default_model())
    phone, n = "(555) 123-4567", 1200
    texts = [("12 of the " * n)[: 10 * k] + f"my number is {phone} and " + "12 of the " * (n - k) for k in range(120, 200)]
    got = finder.spans(texts)
    for text, (_, spans) in zip(texts, got, strict=True):
        at = text.index(phone)
        assert ("phone", at, at + len(phone)) in spans
    assert len({len(spans) for _, spans in got}) == 1


def test_sequences_of_any_length_decode_alike_alone_and_together():
    model = pii.default_model()
    rng = np.random.default_rng(4)
    some = [crf.features(t, s) for t, _, s in (crf.tokenize(" ".join(str(x) for x in rng.integers(0, 10**6, n))) for n in (3, 1, 40, 900, 41, 5))]
    alone = [model.viterbi([s])[0] for s in some]
    assert all(np.array_equal(a, b) for a, b in zip(alone, model.viterbi(some, tokens=100), strict=True))
    assert all(np.array_equal(a, b) for a, b in zip(alone, model.viterbi(some), strict=True))


def test_pieces_round_trip_and_score():
    model = sentencepiece.PieceModel()
    segmenter = model.segmenter()
    texts = ["", " ", "a  b ", "\t x\n\n y 🙂 日本", "▁a", "hello world", "ñandú " * 50, "x" * 300]
    for text, raw in zip(texts, segmenter.encode([t.encode() for t in texts], model.whole), strict=True):
        ids = np.frombuffer(raw, np.int32)
        assert model.decode(ids, np.array([0, len(ids)]))[0].decode() == text
        if text:
            whole = segmenter.path(b" " + text.encode())
            score = lambda x: sum(model.scores[k] for k in x if model.scores[k] < 0)
            assert abs(score(whole) - score(ids.tolist())) < 1e-6


def test_token_counts_are_greedy():
    pieces = [p.text for p in read_pieces() if p.kind == NORMAL]
    known, automaton, longest = set(pieces), token_counts.Automaton(pieces), max(map(len, pieces))

    def greedy(word):
        at = n = 0
        while at < len(word):
            end = next((e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in known), None)
            if end is None:
                return -1
            at, n = end, n + 1
        return n

    rng = np.random.default_rng(2)
    for _ in range(3000):
        word = MARK + "".join(rng.choice(list("abcdeinorst.,'1éß日"), rng.integers(1, 14)))
        assert automaton.count(word) == greedy(word), word


def test_url_rules_nest(spark):
    rules = [("com", "/", "allow"), ("a.com", "/x", "block"), ("b.a.com", "/x/y", "allow"), ("com", "", "block"), ("", "/", "block"), ("a.com", "/x", "allow")]
    urls = ["http://b.a.com/x/y?q", "http://B.A.com/x", "http://ba.com/x/y", "http://a.com", "ftp://c.net/x", "none", None, "http://x.b.a.com/x/yz#f", "://", "http://b.a.com/x/y?q"]
    pages = spark.createDataFrame([(k, u, "r") for k, u in enumerate(urls)], "page_id long, url string, rule string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: r for r in url_rules.judge_urls(pages, table, salts=3).collect()}
    kept = {}
    for h, p, v in rules:
        if h:
            kept[h, p] = max(v, kept.get((h, p), v))
    for k, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host, path = re.match(r"[^/?#]*", rest).group().lower(), re.match(r"[^/?#]*([^?#]*)", rest).group(1)
        fits = [(len(h + p), h + p, v) for (h, p), v in kept.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == (host, path, *best[1:])


def test_url_answers_reach_a_crowded_host(spark):
    """Repeated rows, columns that cannot be hashed and a host with most rows: each row has its answer once."""
    rows = [(k % 900, "http://a.com/en/p" if k % 10 else f"http://h{k}.net/fr/", {"k": k % 3}) for k in range(1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, extra map<string,int>")
    rules = spark.createDataFrame(url_rules.RULES, "host string, path string, verdict string")
    got = url_rules.judge_urls(pages, rules)
    assert got.columns == ["page_id", "url", "extra", "host", "path", "rule", "verdict"]
    found = Counter((r.page_id, r.rule, r.verdict) for r in got.collect())
    assert found == Counter((i, "com/", "allow") if "a.com" in u else (i, "net/fr/", "block") for i, u, _ in rows)


def test_url_tables_may_be_empty_or_clash(spark):
    rules = spark.createDataFrame(url_rules.RULES, "host string, path string, verdict string")
    rows = [(1, "http://a.net/es/x", "h", 5, "s", 2), (1, "http://a.net/es/x", "h", 5, "s", 2), (2, None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, __host string, __salt int, __starts string, c0 int")
    got = sorted(map(tuple, url_rules.judge_urls(pages, rules).collect()))
    assert got == sorted([(*r, "a.net", "/es/x", "net/es/", "block") for r in rows[:2]] + [(*rows[2], "", "", None, "allow")])
    assert url_rules.judge_urls(pages.filter("false"), rules).count() == 0
    free = url_rules.judge_urls(pages, rules.filter("false")).collect()
    assert len(free) == 3 and {(r.rule, r.verdict) for r in free} == {(None, "allow")}


def test_filters_return_the_callers_columns(spark):
    """A filter's verdict is its own, whatever columns the caller has."""
    good = "The council met on Tuesday to discuss the new bridge, and most members agreed that it was needed for the town. " * 3
    rows = [(k, good + str(k), 777, 0.25, False, True, "x") for k in range(8)] + [(8, None, None, None, None, None, None), (9, "a b c d e f g h i j k l m", 1, 2.0, True, False, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, score double, keep boolean, contaminated boolean, hits string")
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l m")], "item_id long, text string")
    clean = decontaminate.decontaminate(docs, items)
    assert clean.columns == docs.columns and sorted(map(tuple, clean.collect())) == sorted(rows[:9])
    model = quality.train(docs, sample_rows=50)
    want = {r.doc_id for r in quality.judge(docs.select("doc_id", "text"), model=model).collect() if r.keep}
    kept = quality.drop_bad(docs, model=model)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == sorted(r for r in rows if r[0] in want)
    assert decontaminate.decontaminate(docs.filter("false"), items).count() == 0 == quality.drop_bad(docs.filter("false"), model=model).count()


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=8) * (1 if i % 3 else 0.1)]) for i in range(400)]
    rows += [(-50, rows[7][1]), (-3, rows[50][1]), (400, rows[0][1]), (401, None), (402, [float("nan")] * 8), (403, [1.0] * 3), (None, rows[1][1]), (404, [None] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.top_k(vectors, F.col("vec_id") % 50 == 0, data_block=90, query_block=3).collect()
    whole = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    want = []
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_near_duplicates_match_all_pairs(spark, documents):
    got = near_duplicates.near_duplicate_classes(spark.createDataFrame(documents)).toPandas().set_index("id")
    sets = {i: near_duplicates.shingle_counts(np.frombuffer((t or "").encode(), np.uint8))[:2] for i, t in zip(documents.doc_id, documents.text, strict=True)}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if near_duplicates.weighted_jaccard(*_floats(sets[a]), *_floats(sets[b])) >= 0.8:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    same = sum(got.class_id[i] == root(i) for i in ids)
    assert same >= 0.98 * len(ids)  # frequencies move a few similarities across the threshold
    assert got.stays.sum() == got.class_id.nunique()


def test_pairs_of_one_crowded_template_are_found(spark):
    rng = np.random.default_rng(1)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    # 353 of 400 words in all texts, whose weights fall by a quarter: any two are similar by 0.74, the two of a pair by 0.81.
    template, rows = words(353), []
    for k in range(200):
        both = template + words(16)
        rows += [(2 * k + half, " ".join(both + words(31))) for half in range(2)]
    got = near_duplicates.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).toPandas().set_index("id")
    assert [got.class_id[k] for k in range(400)] == [k - k % 2 for k in range(400)]


def test_block_similarity_is_that_of_each_pair():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(12):
        items = np.unique(rng.integers(0, 60, 40)).astype(np.int32)
        sets.append((items, rng.choice([0.75, 0.8, 1, 2, 3, 7], len(items)).astype(np.float32)))
    got = near_duplicates.block_similarity([s for s, _ in sets], [w for _, w in sets], np.arange(5), np.arange(5, 12), wide=16)
    want = [[near_duplicates.weighted_jaccard(*sets[a], *sets[b]) for b in range(5, 12)] for a in range(5)]
    assert np.allclose(got, want, atol=1e-5)


def _floats(counted):
    return counted[0], counted[1].astype(float)


def test_samples_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(0)
    agree, similar = [], []
    for _ in range(60):
        items, weights = rng.integers(0, 1 << 63, 100).astype(np.uint64), rng.integers(1, 4, 100).astype(float)
        a, b = np.sort(items[:90]), np.sort(items[10:])
        w = dict(zip(items.tolist(), weights, strict=True))
        wa, wb = (np.array([w[x] for x in s.tolist()]) for s in (a, b))
        agree.append((near_duplicates.weighted_samples(a, wa) == near_duplicates.weighted_samples(b, wb)).mean())
        similar.append(near_duplicates.weighted_jaccard(a, wa, b, wb))
    assert abs(np.mean(agree) - np.mean(similar)) < 0.03


def test_quality_against_held_labels(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.judge(docs).join(labels, "doc_id").select("keep", "quality").toPandas()
    assert (got.keep == (got.quality == 1)).mean() > 0.93
    assert got[got.quality == 1].keep.mean() > 0.97


def test_quality_model_is_the_same_in_every_run(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one, two = (quality.train(d, sample_rows=60) for d in (docs, docs.repartition(7)))
    assert (one.weights == two.weights).all() and (one.labels.bad_vote == two.labels.bad_vote).all()


ROW_OPERATORS = {
    "suffix": lambda d: suffix_dedup.dedup_digest(d),
    "chunks": lambda d: chunk_dedup.chunk_dedup(d),
    "contamination": lambda d: decontaminate.find_contamination(d, d.select(F.col("doc_id").alias("item_id"), F.substring("text", 1, 80).alias("text"))),
    "pii": lambda d: pii.find_pii(d),
    "mask": lambda d: pii.mask_pii(d),
    "pieces": lambda d: sentencepiece.decode(sentencepiece.encode(d)),
    "pieces at once": lambda d: sentencepiece.encode(d, decoded_col="decoded"),
    "tokens": lambda d: token_counts.token_counts(d),
    "quality": lambda d: quality.judge(d),
    "near": lambda d: near_duplicates.near_duplicate_classes(d),
}


@pytest.mark.parametrize("name", ROW_OPERATORS)
def test_awkward_and_empty_tables(awkward, name):
    got = ROW_OPERATORS[name](awkward).toPandas()
    assert len(got) == awkward.count()
    assert ROW_OPERATORS[name](awkward.filter("false")).count() == 0
    if name == "suffix":
        assert sorted(got.n_removed)[-3:] == sorted([900, *[len("lorem ipsum dolor sit amet " * 20_000)] * 2])
    if name.startswith("pieces"):
        assert all(a == b or (a is None and b is None) for a, b in zip(got.decoded, got.text, strict=True))
    if name == "near":
        assert got[got.id == 4].class_id.tolist() == got[got.id == 5].class_id.tolist() == [4]
