"""Alignment of two tokenizers against whole tokenization and plain loops."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelkit.llm import token_alignment
from panelkit.llm.token_alignment import BYTE_BPE, align_tokens, op11_token_alignment
from panelkit.llm.vocab import PIECES


def plain(texts):
    """Rows (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of texts cut whole, and the pairs' document counts."""
    a_cut, b_cut = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_cut.encode_special_tokens = True
    letters = token_alignment.byte_letters()
    found, held = [], Counter()
    for t in texts:
        raw = (" " + (t or "")).encode()
        a, b = a_cut.encode(" " + (t or ""), add_special_tokens=False).ids, b_cut.encode(t or "")
        a_bytes = [bytes(letters[c] for c in a_cut.id_to_token(k)) for k in a]
        b_bytes = [bytes([int(b_cut.id_to_piece(k)[3:5], 16)]) if b_cut.is_byte(k) else b_cut.id_to_piece(k).replace("▁", " ").encode() for k in b]
        if not t or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            found.append(None)
            continue
        a_end, b_end = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        groups, start = [], 0
        for end in sorted(set(a_end) & set(b_end)):
            own = ([k for k, e in zip(ids, ends, strict=True) if start < e <= end] for ids, ends in ((a, a_end), (b, b_end)))
            groups.append(tuple(own))
            start = end
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        held.update(links.keys())
        found.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    rows = []
    for f in found:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        n_best = sum(n for p, n in links.items() if held[p] == best[p[0]])
        rows.append((n_a, n_b, len(groups), sum(links.values()), n_best, sum(n * held[p] for p, n in links.items()), text))
    return rows, held


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
AWKWARD = [
    None, "", " ", "\n", "plain words here", "plain words here", " two  spaces and\t\ttabs \n\n lines ", "<|endoftext|> and <s> are text", "▁ is a space to B",
    "a▁b", "日本語のテキスト ñandú 🙂🙂", "x" * 3000, "aaaa " * 500, "-" * 999 + "=" * 1001, "don't we'll I'm", " leading", "trailing ", "\x00 zero", "a b c　d e",
    "\x1c\x1d a \x85 b", "12345678901234567890 0.5e-10", "end\r\n \r\n x",
]


@pytest.mark.parametrize("block_bytes", [1 << 23, 40])
def test_alignment_matches_plain_loops(spark, block_bytes):
    rows = [(k, t, "x", 5) for k, t in enumerate(AWKWARD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, groups string, n_a int")
    got = align_tokens(docs, block_bytes=block_bytes)
    want, held = plain(AWKWARD)
    assert got.documents.columns[0] == "doc_id"
    found = {r.doc_id: tuple(r[c] for c in FIELDS) for r in got.documents.collect()}
    assert [found[k] for k in range(len(rows))] == want
    pairs = {(r.a_id, r.b_id): (r.n_docs, r.best) for r in got.pairs.collect()}
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    assert pairs == {p: (n, n == most[p[0]]) for p, n in held.items()}


def test_random_texts_are_cut_as_whole_texts(monkeypatch):
    """Words cut one by one give the tokens of the whole text; forgotten words give the same again."""
    rng = np.random.default_rng(3)
    letters = [" ", " ", " ", "  ", "\n", "\t", " ", "'", "s", "ll", "the", "token", "é", "日", "🙂", "1", "23", ".", "--", "A", "Ġ", "<s>"]
    texts = ["".join(rng.choice(letters, rng.integers(1, 40))) for _ in range(400)]
    with open(BYTE_BPE, encoding="utf-8") as f, open(PIECES, "rb") as g:
        byte_json, model = f.read(), g.read()
    aligner = token_alignment.Aligner(byte_json, model, token_alignment.byte_tokens(byte_json), token_alignment.piece_tokens(PIECES))
    assert aligner.by_word
    want, _ = plain(texts)
    for limit in (1 << 30, 50):
        monkeypatch.setattr(token_alignment, "REMEMBERED", limit)
        monkeypatch.setattr(token_alignment, "LARGE", 4 if limit == 50 else 4096)
        for t, w in zip(texts, want, strict=True):
            n_a, n_b, windows = aligner.documents([t])[0]
            assert (n_a, n_b, ";".join(aligner.texts[k] for k in windows)) == (w[0], w[1], w[6]), t
            lengths, groups, links = aligner.counts.rows(windows)
            assert (groups.sum(), links.sum()) == (w[2], w[3]) and (lengths == 1).all()
            if aligner.full():
                aligner.forget()


def test_the_query_over_a_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").toPandas()
    want, _ = plain(docs.text)
    got = op11_token_alignment(spark, sf).toPandas().set_index("doc_id")
    assert list(got.columns) == [*FIELDS[:-1], "groups_sha256"]
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    assert [tuple(got.loc[i]) for i in docs.doc_id] == [(*w[:-1], digest(w[-1])) for w in want]


def test_empty_and_repeated_rows(spark):
    rows = [(1, "same text"), (1, "same text"), (None, "same text"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert align_tokens(docs.filter("false")).documents.count() == 0
    got = align_tokens(docs).documents.orderBy(F.col("doc_id").asc_nulls_first()).collect()
    assert [r.doc_id for r in got] == [None, 1, 1, 2]
    assert [r.count_sum for r in got] == [3 * got[0].n_links] * 3 + [0]
