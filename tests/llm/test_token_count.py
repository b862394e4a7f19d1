import sentencepiece
from casemill.llm.queries import tokenizer
from casemill.llm.token_count import Pieces, token_counts

MODEL = tokenizer("piece_bpe_32k.model")
TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a▁b", "▁", "▁▁x", "line\nnext\n\nthird ", "tab\there", "<s> and </s>", "<unk>",
         "émoji 😀😀 ok", "x" * 5000, "word " * 3000, "0 12 345  ", "　wide", "\x00nul"]


def test_counts_equal_the_library(spark, docs):
    whole = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (None, "a b"), (1, " ")]
    got = token_counts(docs(*rows).selectExpr("*", "1 AS n_tokens", "2 AS n_bytes"), MODEL, limit=2500).collect()
    want = sorted((-1 if i is None else i, len((t or "").encode()), len(whole.encode(t or ""))) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2500) for r in got)


def test_whole_token_proof_and_small_cache():
    p = Pieces(MODEL, limit=3)
    assert p.separable and len(p.whole) > 10_000
    for w in [w for w in p.whole if w][::997]:
        assert len(p.model.encode(w)) == 1
    text = " ".join(f"qzx{i}vw" for i in range(50)) + " the the"
    assert p.count(text) == len(p.model.encode(text)) and len(p.counts) <= len(p.whole) + 3


def test_empty_table(spark, docs):
    assert token_counts(docs(), MODEL).count() == 0
