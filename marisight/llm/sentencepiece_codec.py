"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The encoder keeps a *score-ordered agenda* of adjacent symbol pairs: every neighbouring pair that
spells a vocabulary piece waits in a heap ordered by (score descending, position ascending); the
best pair is merged, its two new neighbour pairs enter the agenda, and entries whose symbols have
changed meanwhile are skipped.  What stays outside the vocabulary falls back to UTF-8 byte pieces.

No piece of such a vocabulary holds a space mark after another character, and none holds a line
feed, so merges never cross the start of a run of space marks or a line feed.  Texts are therefore
cut there, and the agenda runs once per distinct cut in a worker; a bounded memo keeps the result.  For
each Arrow batch the library encodes every cut that was new, in one call, and must give the same ids.
Both facts are verified against the vocabulary when a model is loaded.

Defined results: null and empty texts have no ids and decode to the empty text; texts of any length
are encoded whole; other columns pass through unchanged, repeated rows give repeated results.
"""

from __future__ import annotations

import gc
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from marisight.llm._batches import give_back

MARK = "▁"
#: distinct cuts kept by one worker before its memo starts again
MEMO_ENTRIES = 400_000
_CUTS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def default_model_path() -> str:
    """The public 32k vocabulary that the container offers; the path is a parameter everywhere."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """Vocabulary of a merge-type SentencePiece model, with an agenda-based encoder."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, n = self.library, self.library.vocab_size()
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        for i in range(n):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.ids[piece], self.scores[piece] = i, lib.get_score(i)
        if any((MARK in p[1:] and p.strip(MARK)) or "\n" in p for p in self.ids):
            raise ValueError("pieces of this vocabulary cross spaces or lines; it can't be cut there")
        self.newline = (self.bytes[10],)
        self.memo: dict[str, tuple[int, ...]] = {}
        self.fresh: list[tuple[str, tuple[int, ...]]] = []

    def merge(self, text: str) -> list[str]:
        """Pieces of one cut, by the agenda."""
        return self.merge_short(text) if len(text) <= 48 else self.merge_long(text)

    def merge_short(self, text: str) -> list[str]:
        """The agenda as a list in text order: of a few pairs, a scan finds the best one fastest."""
        score, none, symbols = self.scores.get, float("-inf"), list(text)
        agenda = [score(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = max(agenda)
            if best == none:
                break
            i = agenda.index(best)  # the leftmost of equal scores
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del agenda[i]
            if i < len(agenda):
                agenda[i] = score(symbols[i] + symbols[i + 1], none)
            if i:
                agenda[i - 1] = score(symbols[i - 1] + symbols[i], none)
        return symbols

    def merge_long(self, text: str) -> list[str]:
        """The agenda as a heap, for cuts of any length."""
        scores, symbols = self.scores, list(text)
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, str]] = []

        def propose(a: int, b: int) -> None:
            pair = symbols[a] + symbols[b]
            score = scores.get(pair)
            if score is not None:
                heapq.heappush(agenda, (-score, a, b, pair))

        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            _, a, b, pair = heapq.heappop(agenda)
            if not symbols[a] or not symbols[b] or right[a] != b or symbols[a] + symbols[b] != pair:
                continue  # one of the two has been merged since
            symbols[a], symbols[b] = pair, ""
            after = right[a] = right[b]
            if after < n:
                left[after] = a
                propose(a, after)
            if left[a] >= 0:
                propose(left[a], a)
        return [s for s in symbols if s]

    def cut_ids(self, cut: str) -> tuple[int, ...]:
        out: list[int] = []
        for piece in self.merge(cut):
            i = self.ids.get(piece)
            if i is None:
                out.extend(self.bytes[b] for b in piece.encode())
            else:
                out.append(i)
        return tuple(out)

    def marked(self, word: str) -> tuple[int, ...]:
        """Ids of a space mark and a word, by the memo."""
        found = self.memo.get(word)
        if found is None:
            found = self.cut_ids(MARK + word)
            if len(word) < 256:
                if len(self.memo) >= MEMO_ENTRIES:
                    self.memo.clear()
                self.memo[word] = found
            if word:
                self.fresh.append((word, found))
        return found

    def check(self) -> None:
        """Compares what has been encoded since the last check with the library: all new cuts, in one call."""
        fresh, self.fresh = self.fresh, []
        lead = self.library.encode("\n")
        for (said, found), ids in zip(fresh, self.library.encode([said for said, _ in fresh]) if fresh else ()):
            if said[0] == "\n":  # a line start: what the library puts before it goes
                ids = ids[len(lead) :] if ids[: len(lead)] == lead else None
            if ids is None or tuple(ids) != found:
                raise AssertionError(f"agenda and library differ on {said!r}: {found} and {ids}")

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, as the library gives them without begin, end or sampling."""
        if not text:
            return []
        get, parts = self.memo.get, []
        spaced = "  " in text or MARK in text
        for k, line in enumerate(text.split("\n")):
            if k:
                parts.append(self.newline)
            if spaced or line[:1] == " " or line[-1:] == " ":
                whole = line.replace(" ", MARK)
                begun = len(parts)
                for cut in _CUTS.findall(whole if k else MARK + whole):
                    parts.append(self.marked(cut[1:]) if cut[0] == MARK and MARK not in cut[1:] else self.cut_ids(cut))
                if line:
                    self.fresh.append(("\n" + line if k else line, tuple(chain.from_iterable(parts[begun:]))))
                continue
            words = line.split(" ")
            if k:
                if words[0]:
                    parts.append(self.line_start(words[0]))
                del words[0]
            ids = list(map(get, words))
            if None in ids:
                ids = [self.marked(w) if i is None else i for w, i in zip(words, ids)]
            parts += ids
        return list(chain.from_iterable(parts))

    def line_start(self, word: str) -> tuple[int, ...]:
        """Ids of a word that no space mark precedes, by the memo (after a line feed, which no word holds)."""
        found = self.memo.get("\n" + word)
        if found is None:
            found = self.cut_ids(word)
            if len(word) < 256:
                if len(self.memo) >= MEMO_ENTRIES:
                    self.memo.clear()
                self.memo["\n" + word] = found
            self.fresh.append(("\n" + word, found))
        return found


_LOADED: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model, loaded once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceModel(path)
    return _LOADED[path]


def encode_and_decode(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """df with ``piece_ids`` (array of int) and ``decoded`` (string) of its whole ``text`` column.

    Encoding uses the agenda, decoding the library's ``decode(ids)``.  One narrow pass, no shuffle.
    """
    path = path or default_model_path()
    names = [c for c in df.columns if c not in ("piece_ids", "decoded")]
    kept = df.select(*names)
    fields = [*kept.schema.fields]
    schema = StructType([*fields, StructField("piece_ids", ArrayType(IntegerType())), StructField("decoded", StringType())])
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        m.memo.clear()  # workers live on for other tasks, of which one may need the memory
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):  # ids of 512 texts at a time are Python objects
                batch = whole.slice(lo, 512)
                gc.disable()  # the memo has no cycles, and its tuples are many
                try:
                    rows = [m.encode(t or "") for t in batch.column(at).to_pylist()]
                    m.check()
                finally:
                    gc.enable()
                offsets = np.zeros(len(rows) + 1, np.int32)
                np.cumsum([len(r) for r in rows], out=offsets[1:])
                flat = np.fromiter(chain.from_iterable(rows), np.int32, int(offsets[-1]))
                decoded = m.library.decode(rows) if rows else []
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(decoded, pa.string())], names=[*names, "piece_ids", "decoded"])
        m.memo.clear()
        give_back()

    return kept.mapInArrow(run, schema)


def decode(ids: Column, path: str | None = None) -> Column:
    """Text of an array<int> column of piece ids; null arrays give the empty text."""
    path = path or default_model_path()
    @pandas_udf(StringType())
    def run(column: pd.Series) -> pd.Series:
        lib = model(path).library
        return pd.Series([lib.decode([int(i) for i in x]) if x is not None and len(x) else "" for x in column], dtype=object)

    return run(ids)


def digests(df: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of an encoded frame."""
    return df.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("piece_ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded; see the module for defined results."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(encode_and_decode(docs))
