"""Token counts of whole texts without their ids."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import mul

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.blocks import text_blocks, worker_state

REMEMBERED = 150_000
# Merges never reach across these cuts: before a blank that follows something else, and around a line end.
PRE_TOKENS = re.compile("\n|[ ▁]+[^ ▁\n]*|[^ ▁\n]+")


class PieceCounter:
    """Number of pieces of a pre-token under a sentencepiece BPE model, remembered up to a bound.

    The model must suit ``PRE_TOKENS``: no piece has a blank after another character, none holds a
    line end, and texts are not normalised but get one blank in front. A pre-token is counted
    behind a line end, which keeps that blank apart from it.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any(re.search("[^▁]▁|\n.|.\n", piece, re.S) for piece in pieces):
            raise ValueError("pieces of this model reach across the cuts")
        probe = self.model.encode("a  ﬁ ", out_type=str)
        if "".join(probe) != "▁a▁▁ﬁ▁":
            raise ValueError("this model normalises texts")
        self.skip = len(self.model.encode("\n", num_threads=1))
        self.known: dict[str, int] = {}

    def learn(self, tokens: set[str]) -> None:
        """Count the pieces of pre-tokens that aren't known yet, each once."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [token for token in tokens if token not in self.known]
        found = self.model.encode(["\n" + token for token in new], num_threads=1)
        self.known.update((token, len(ids) - self.skip) for token, ids in zip(new, found, strict=True))

    def count_block(self, texts: list[str]) -> list[int]:
        """Tokens of each text: its pre-token frequencies joined to their counts, and summed."""
        frequencies = [Counter(PRE_TOKENS.findall(" " + text)) if text else Counter() for text in texts]
        self.learn(set().union(*frequencies))
        return [sum(map(mul, f.values(), map(self.known.__getitem__, f))) for f in frequencies]


def count_tokens(
    docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of whole texts, as the model's library would encode them.

    A null text counts as empty and has no tokens; null and repeated ids are kept as they are, other
    columns are left out.

    Pre-tokens are counted once in each block of texts, joined there to the frequencies of the block's
    documents, and remembered by the worker. A join across the table would send a row per document and
    pre-token through a shuffle, about six times as many as there are documents times a hundred words; most
    pre-tokens that are not remembered occur once in the table, so it would save next to no counting.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_state(PieceCounter, path)
        for block in text_blocks(batches, text_col):
            tokens = counter.count_block([text or "" for text in block.column(text_col).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [block.column(id_col), block.column("n_bytes"), pa.array(tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    n_bytes = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    rows = docs.select(id_col, text_col, n_bytes.alias("n_bytes"))
    counted = rows.mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
