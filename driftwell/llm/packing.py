"""Token packing: concatenate and cut.

Pass one turns every document into ids and sums them within its partition; the prefix sums over the
partition totals, one number each, then give every document its place in one long sequence of ids.
Pass two cuts that sequence into fixed windows: a piece is what one window takes of one document.
Only the last window is padded.

The ids of pass one are written to the shared folder, so that an executor lost in pass two costs no
new tokenising and can not change a total.

Defined cases: a null or empty text is its end id alone; a control string of the tokenizer inside a
text is that string's id, as ``encode(text, add_special_tokens=False)`` has it; repeated rows and null ids are documents of their own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from driftwell.llm.common import id_and_text, staged

WINDOW = 2048
END_ID = 1
# Runs of one kind of character beyond this length go to the tokenizer's own merge loop.
LONG_RUN = 2_000
_PROBES = ["", "Hello, wörld!  It's 12 o'clock\n\n\tok <|end of text|> ", "éàü ñ 漢字 🙂 a b  x", "x" * 50, " " * 40 + "y"]


class ByteBpe:
    """Ids of a byte-level BPE file of the ``tokenizers`` library.

    The vocabulary is read from the file.  Where its pre-tokeniser is the common byte-level one,
    ``tiktoken`` runs the same merges over the same ranks several times faster; probes at loading
    time and the tests hold both to the same ids.  Texts in which an added token of the file stands,
    and all texts of any other file, are left to ``tokenizers``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.added = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = self._ranks(path)
        if self.fast and [self.fast.encode_ordinary(p) for p in _PROBES] != [self._by_file(p) for p in _PROBES]:
            self.fast = None

    def _by_file(self, text: str) -> list[int]:
        return self.slow.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _ranks(path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        before = stored.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space", True) and not stored.get("normalizer")
        if not plain or stored["model"]["type"] != "BPE":
            return None
        # Bytes that can be shown stand for themselves, the others follow in order from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = {t["content"] for t in stored.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in stored["model"]["vocab"].items() if t not in special}
        # Fixed value: the pattern of the common byte-level pre-tokeniser.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is None or any(token in text for token in self.added):
            return self._by_file(text)
        if len(text) > LONG_RUN:
            words = text.split()
            if max(map(len, words), default=0) > LONG_RUN or len(text) - sum(map(len, words)) - len(words) > LONG_RUN:
                return self._by_file(text)
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


def token_table(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Pass one: ``part, start, doc_id, n, ids`` with ``start`` counted within the partition.

    ``ids`` holds little-endian numbers of two bytes if the vocabulary allows, else of four.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = tokenizer(path)
        kind = "<u2" if max(bpe.slow.get_vocab_size(), end_id) <= 1 << 16 else "<u4"
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            # Small steps, so that what is held does not follow the length of the texts.
            for at in range(0, len(batch), 512):
                rows = []
                for doc_id, text in zip(batch["doc_id"].iloc[at : at + 512], batch["text"].iloc[at : at + 512]):
                    ids = np.array([*bpe.encode(text or ""), end_id], dtype=kind)
                    rows.append((part, start, None if pd.isna(doc_id) else int(doc_id), len(ids), kind, ids.tobytes()))
                    start += len(ids)
                yield pd.DataFrame(rows, columns=["part", "start", "doc_id", "n", "kind", "ids"]).astype({"doc_id": "Int64"})

    rows = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return staged(rows.mapInPandas(encode, "part int, start long, doc_id long, n long, kind string, ids binary"), "tokens")


def pack_documents(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit numbers; ``start`` counts the document's ids before
    the piece and ``offset`` is its place in the window.
    """
    tokens = token_table(docs, path, id_col=id_col, text_col=text_col, end_id=end_id)
    # One row for each partition of the input.
    totals = {r["part"]: r["n"] for r in tokens.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    places, base = {}, 0
    for part in sorted(totals):
        places[part] = base
        base += totals[part]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            rows = []
            for part, start, doc_id, n, kind, ids in batch.itertuples(index=False, name=None):
                wide = np.frombuffer(ids, dtype=kind).astype("<u4")
                place = places[part] + start
                done = 0
                while done < n:
                    sequence, offset = divmod(place + done, window)
                    length = min(window - offset, n - done)
                    piece = wide[done : done + length].tobytes()
                    rows.append((None if pd.isna(doc_id) else int(doc_id), done, length, piece, n, sequence, offset))
                    done += length
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return tokens.select("part", "start", "doc_id", "n", "kind", "ids").mapInPandas(cut, schema)
