"""SentencePiece encoding by backtracking, and decoding (operator 3).

The model merges pairs of neighbouring pieces, best score first. The result can
be found without a queue of merges: a sequence of pieces is that result exactly
if every two neighbours would end up apart when merged together. So the encoder
walks forward by longest matches, checks each new neighbour, and where none
fits takes the previous piece back, marking the place as failed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import map_arrow, table

SPACE = "▁"
#: Runs of spaces, each with the text up to the next: no piece goes across, as the
#: loader checks, so runs are encoded one by one and remembered.
_RUN = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Runs remembered by a Python worker in each of two generations.
CACHE_RUNS = 250_000
LONGEST_REMEMBERED = 64


class Codec:
    """Encoder and decoder for one merge-type model file with byte fallback."""

    def __init__(self, model_file: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = self.library.get_piece_size()
        ids = range(size)
        special = {
            i
            for i in ids
            if self.library.is_control(i)
            or self.library.is_unknown(i)
            or self.library.is_byte(i)
            or self.library.is_unused(i)
        }
        self.piece = [self.library.id_to_piece(i) for i in ids]
        self.score = [self.library.get_score(i) for i in ids]
        self.id_of = {self.piece[i]: i for i in ids if i not in special}
        self.byte_id = {int(self.piece[i][3:5], 16): i for i in ids if self.library.is_byte(i)}
        self.end = self.library.eos_id()
        if len(self.byte_id) != 256 or any(SPACE in p.lstrip(SPACE) for p in self.id_of):
            raise ValueError("needs a model with byte fallback whose pieces have spaces in front only")
        self.matcher = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            self.matcher.add_word(piece, i)
        self.matcher.make_automaton()
        self.length = list(map(len, self.piece))
        self.characters = {p for p in self.id_of if len(p) == 1}
        self.numbers = list(ids)  # shared, so that remembered ids are references
        self.decimal = [f"{i} " for i in ids]
        self.apart: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int] = {}
        self.young: dict[str, tuple[str, tuple[int, ...]]] = {}
        self.old: dict[str, tuple[str, tuple[int, ...]]] = {}

    def merged(self, text: str) -> list[int]:
        """The pieces of a short text by repeated merging; used once for each piece and pair."""
        parts = list(text)
        while len(parts) > 1:
            best = None
            for k in range(len(parts) - 1):
                i = self.id_of.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best[0]):
                    best = (self.score[i], k)
            if best is None:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.id_of.get(p, -1) for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the joined text of two pieces gives just these two."""
        key = (left, right)
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) > 2_000_000:
                self.apart.clear()
            known = self.apart[key] = self.merged(self.piece[left] + self.piece[right]) == [left, right]
        return known

    def next_shorter(self, piece: int) -> int:
        """The longest piece that is a proper prefix of ``piece``; -1 if there is none."""
        found = self.shorter.get(piece)
        if found is None:
            text = self.piece[piece]
            found = -1
            for n in range(len(text) - 1, 0, -1):
                if text[:n] in self.id_of:
                    found = self.id_of[text[:n]]
                    break
            self.shorter[piece] = found
        return found

    def encode_run(self, text: str) -> list[int]:
        """Ids of a text; characters without a piece become byte ids and part their neighbours."""
        if self.characters.issuperset(text):
            return self.backtrack(text)
        out: list[int] = []
        begin = 0
        for k, c in enumerate(text):
            if c not in self.characters:
                out += self.backtrack(text[begin:k])
                out += [self.byte_id[b] for b in c.encode()]
                begin = k + 1
        return out + self.backtrack(text[begin:])

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text whose every character is a piece."""
        end = len(text)
        whole = self.id_of.get(text)
        if not end or whole is not None:
            return [] if not end else [whole]
        length, apart = self.length, self.apart
        longest: list[int] = [0] * end  # at each place; ends come in order, so the last match is the longest
        for last, i in self.matcher.iter(text):
            longest[last + 1 - length[i]] = i
        failed = 0  # bit k: nothing that ends at k leads to the end
        chosen: list[int] = []
        at, before = 0, -1
        candidate = longest[0]
        while True:
            while candidate >= 0:
                to = at + length[candidate]
                if not failed >> to & 1:
                    if before < 0:
                        break
                    fits = apart.get((before, candidate))
                    if fits or fits is None and self.compatible(before, candidate):
                        break
                candidate = self.next_shorter(candidate)
            if candidate >= 0:
                chosen.append(candidate)
                if to == end:
                    return chosen
                at, before = to, candidate
                candidate = longest[at]
            elif chosen:
                failed |= 1 << at
                candidate = chosen.pop()
                at -= length[candidate]
                before = chosen[-1] if chosen else -1
                candidate = self.next_shorter(candidate)
            else:
                raise ValueError(f"no merge gives {text!r}")

    def remembered(self, run: str) -> tuple[str, tuple[int, ...]]:
        """Ids of a run: in decimal, each with a space behind, and as numbers."""
        found = self.young.get(run) or self.old.get(run)
        if found is None:
            ids = [self.numbers[i] for i in self.encode_run(run)]
            found = "".join([self.decimal[i] for i in ids]), tuple(ids)
        if len(run) <= LONGEST_REMEMBERED:
            self.young[run] = found
            if len(self.young) >= CACHE_RUNS:
                self.old, self.young = self.young, {}
        return found

    def encode_text(self, text: str) -> tuple[str, list[int]]:
        """All ids of a text, the end id last: in decimal joined by spaces, and as numbers."""
        found = []
        if text:
            runs = _RUN.findall(SPACE + text.replace(" ", SPACE))
            found = list(map(self.young.get, runs))
            if None in found:
                found = [f or self.remembered(r) for f, r in zip(found, runs)]
        ids = list(chain.from_iterable([f[1] for f in found]))
        ids.append(self.end)
        return "".join([f[0] for f in found]) + str(self.end), ids

    def encode(self, text: str) -> list[int]:
        return self.encode_text(text)[1]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=2)
def codec(model_file: str) -> Codec:
    """One codec for each Python worker."""
    return Codec(model_file)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py() or ""


def encode_documents(docs: DataFrame, model_file: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id of every row with n_tokens, ids_sha256 and decoded_sha256 (and ids).

    Every text is encoded whole, an end id last, and decoded again. A null or
    empty text has the end id alone. Rows are handled one by one, so repeated
    rows give repeated results and other columns are not read. An empty table
    gives an empty result.

    Without ``model_file`` each worker looks the file up in its own
    installation, so no path of the driver is taken to other machines.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string())])
    schema = schema.append(pa.field("decoded_sha256", pa.string()))
    if with_ids:
        schema = schema.append(pa.field("ids", pa.list_(pa.int32())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model_file or default_model())
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                counts, encoded, decoded, lists = [], [], [], []
                for text in _texts(part.column(1)):
                    line, ids = tool.encode_text(text)
                    counts.append(len(ids))
                    encoded.append(hashlib.sha256(line.encode()).hexdigest())
                    decoded.append(hashlib.sha256(tool.decode(ids).encode()).hexdigest())
                    if with_ids:
                        lists.append(ids)
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)]
                if with_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(rows, run, fields + (", ids array<int>" if with_ids else ""))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
