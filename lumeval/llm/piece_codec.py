"""SentencePiece encoding and decoding with shared-prefix Viterbi search.

A text is cut into marked words: each blank becomes the mark U+2581, one is put in front, and a word is
its marks and what follows up to the next mark or line feed (no piece of the vocabulary goes
on beyond such a border).  The distinct words of a batch are sorted, which lays them out as a trie; the search walks it
depth first, keeps the forward scores of the current path on a stack, and computes only the positions
beyond the prefix shared with the previous word.  The best segmentation has the highest sum of piece
scores, ties going to the longest last piece; characters without a piece cost ten less than the
worst score and are written as bytes, as is the mark itself where the text has one.

Decoding concatenates pieces and bytes, and takes the leading blank off; it returns every text exactly.

Defined results: null and empty texts have no ids and decode to the empty text; repeated rows are encoded
row by row; ids may be null or repeat; other columns are never read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .common import batches

MODEL = "piece_bpe_32k.model"
MARK = "▁"
WORD = re.compile("\n|▁*[^▁\n]+|▁+")
REMEMBERED = 500_000


class Codec:
    """Pieces of a model file, and the ids of the words met so far."""

    def __init__(self, path: str | None = None):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL))
        self.score: dict[str, tuple[float, int]] = {}
        self.byte: dict[int, int] = {}
        self.raw: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:-1], 16)] = i
                self.raw.append(bytes([int(piece[3:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                self.score[piece] = (sp.get_score(i), i)
                self.raw.append(piece.replace(MARK, " ").encode())
        #: Every prefix of a piece -> the piece's score, None for a mere prefix.
        self.prefix: dict[str, float | None] = {}
        for piece, (score, _) in self.score.items():
            for k in range(1, len(piece)):
                self.prefix.setdefault(piece[:k], None)
            self.prefix[piece] = score
        self.penalty = min(s for s, _ in self.score.values()) - 10.0
        self.memory: dict[str, bytes] = {}

    def _ids(self, word: str, back: list[int]) -> bytes:
        out, j = [], len(word)
        while j:
            i = back[j]
            piece = word[i:j]
            hit = self.score.get(piece)
            if hit is None:
                out.extend(self.byte[b] for b in reversed(piece.encode("utf-8", "surrogatepass")))
            else:
                out.append(hit[1])
            j = i
        return np.array(out[::-1], "<u4").tobytes()

    def search(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words, by a depth-first walk over their sorted order."""
        found, prefix = {}, self.prefix
        # of each position: best score, start of the last piece, starts whose text may go on to a piece
        best, back, alive, last = [0.0], [0], [[0]], ""
        for word in sorted(words):
            n = min(len(word), len(last))
            same = 0
            while same < n and word[same] == last[same]:
                same += 1
            del best[same + 1:], back[same + 1:], alive[same + 1:]
            for j in range(same + 1, len(word) + 1):
                top, at, go = best[j - 1] + self.penalty, j - 1, []
                single = True  # the last character as an unknown, until a piece ends here
                for i in alive[j - 1]:
                    text = word[i:j]
                    if text in prefix:
                        go.append(i)
                        score = prefix[text]
                        if score is not None and (best[i] + score > top or single and best[i] + score == top):
                            top, at, single = best[i] + score, i, False
                go.append(j)
                best.append(top)
                back.append(at)
                alive.append(go)
            last = word
            found[word] = self._ids(word, back)
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        cut = []
        for t in texts:
            if not t:
                cut.append([])
            elif MARK in t:  # a mark of the text's own: bytes, between words
                words = []
                for k, part in enumerate(t.split(MARK)):
                    if k:
                        words.append("\x00" + MARK)
                    part = part.replace(" ", MARK)
                    words += WORD.findall(MARK + part if k == 0 else part)
                cut.append(words)
            else:
                cut.append(WORD.findall(MARK + t.replace(" ", MARK)))
        new = set().union(*cut) if cut else set()
        new = [w for w in new if w not in self.memory]
        if len(self.memory) + len(new) > REMEMBERED:
            self.memory.clear()
            new = list(set().union(*cut))
        self.memory.update(self.search([w for w in new if w != "\x00" + MARK]))
        self.memory["\x00" + MARK] = np.array([self.byte[b] for b in MARK.encode()], "<u4").tobytes()
        get = self.memory.__getitem__
        return [b"".join(map(get, words)) for words in cut]

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return raw[1:].decode("utf-8", "surrogatepass") if raw else ""


def encode(docs: DataFrame, keep: list[str] = ("doc_id",), model: str | None = None) -> DataFrame:
    """``keep`` columns, ids (array of int) and round_trip of every row; ``model``: path of a model file."""
    keep = list(keep)
    src = docs.select(*keep, F.col("text").alias("__text"))
    schema = src.select(*keep).schema.add("ids", ArrayType(IntegerType())).add("ids_crc32", "long").add("round_trip", "boolean")

    def run(it):
        codec = Codec(model)
        for batch in batches(it, "__text", 2 << 20):
            texts = batch.column(batch.schema.get_field_index("__text")).to_pylist()
            raw = codec.encode(texts)
            ids = [np.frombuffer(r, "<i4") for r in raw]
            same = [codec.decode(i) == (t or "") for i, t in zip(ids, texts)]
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(ids, pa.list_(pa.int32())), pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                 pa.array(same)], names=[*keep, "ids", "ids_crc32", "round_trip"])

    return src.mapInArrow(run, schema)


def decode(rows: DataFrame, ids: str = "ids", keep: list[str] = ("doc_id",), model: str | None = None) -> DataFrame:
    """``keep`` columns and text of every row of encoded texts."""
    keep = list(keep)
    src = rows.select(*keep, F.col(ids).alias("__ids"))
    schema = src.select(*keep).schema.add("text", "string")

    def run(it):
        codec = Codec(model)
        for batch in it:
            col = batch.column(batch.schema.get_field_index("__ids"))
            texts = [codec.decode(np.asarray(v.values, np.int64)) if v.is_valid else "" for v in col]
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.string())], names=[*keep, "text"])

    return src.mapInArrow(run, schema)
