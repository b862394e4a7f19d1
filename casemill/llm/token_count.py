"""Token counts with a whole-token shortcut.

A sentencepiece BPE model writes each space as U+2581 and prefixes the text
with one.  If no piece of the vocabulary has U+2581 after another character,
no merge can cross into a following space, so a text's pieces are those of its
pre-tokens (a run of spaces and the characters up to the next space) taken
one by one.  `Pieces` proves that for its vocabulary, and proves which
vocabulary strings encode alone as one token.  Pre-tokens among those strings
count 1 without any merging; only the rest go through the library, once per
distinct pre-token while it stays in a bounded cache.

Null and empty texts have 0 tokens and 0 bytes.  Malformed UTF-8 counts as
U+FFFD, as the library reads it.  Repeated rows are counted row by row.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import arrow_map, as_text, raw_text

SPACE = "▁"
LONG = 64  # characters; counts of longer pre-tokens are not kept


class Merged(dict):
    """Token counts of pre-tokens: the proven whole tokens, plus what the
    library merged so far, forgotten when there are more than `limit`."""

    def __init__(self, whole: dict[str, int], encode, limit: int):
        super().__init__(whole)
        self.whole, self.encode, self.limit = whole, encode, limit

    def __missing__(self, pre_token: str) -> int:
        n = len(self.encode(pre_token))
        if len(pre_token) > LONG:
            return n
        if len(self) >= self.limit + len(self.whole):
            self.clear()
            self.update(self.whole)
        self[pre_token] = n
        return n


class Pieces:
    """A sentencepiece model with its proofs.

    `separable`: pre-tokens can be counted one by one.  `whole`: vocabulary
    strings (without their leading U+2581) that encode alone as one token.
    """

    def __init__(self, model: str, limit: int = 400_000):
        import sentencepiece as sp
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.model = sp.SentencePieceProcessor(model_file=model)
        proto = pb.ModelProto.FromString(self.model.serialized_model_proto())
        kinds = pb.ModelProto.SentencePiece
        drawn = [p.piece for p in proto.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED)]
        spec = proto.normalizer_spec
        self.separable = (
            spec.name == "identity" and not spec.precompiled_charsmap and spec.add_dummy_prefix
            and not spec.remove_extra_whitespaces and not proto.trainer_spec.treat_whitespace_as_suffix
            and not any(SPACE in p.lstrip(SPACE) for p in drawn)
        )
        alone = [p[1:] for p in drawn if p.startswith(SPACE) and SPACE not in p[1:] and len(p) > 1]
        self.whole = {p: 1 for p, ids in zip(alone, self.model.encode(alone), strict=True) if len(ids) == 1}
        # one space before a space or the end: the library drops a text that is
        # only its own prefix, so this pre-token is measured behind a letter
        self.whole[""] = len(self.model.encode("a ")) - len(self.model.encode("a"))
        self.counts = Merged(self.whole, self.model.encode, limit)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.separable:
            return len(self.model.encode(text))
        text = text.replace(SPACE, " ")
        spaced = " " + text
        if "  " in spaced or spaced[-1] == " ":
            words = [p[1:] for p in re.findall(" +[^ ]*", spaced)]
        else:
            words = text.split(" ")
        return sum(map(self.counts.__getitem__, words))


@lru_cache(maxsize=2)
def pieces(model: str) -> Pieces:
    return Pieces(model)


COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit` of every row of `docs`
    (`doc_id`, `text`; other columns are ignored)."""

    def count(rows):
        p = pieces(model)
        return [(i, len(raw or b""), p.count(as_text(raw))) for i, raw in rows]

    out = docs.select(F.col("doc_id").cast("long"), raw_text("text"))
    out = out.mapInArrow(arrow_map(count, COUNTS), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
