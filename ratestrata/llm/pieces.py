"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

An agenda holds the adjacent symbol pairs whose join is in the vocabulary, best score first, leftmost first among
equals; the best pair merges and its new neighbours enter, until no pair is left. Symbols outside the vocabulary become
byte pieces. No piece of the vocabulary holds a mark of a blank after another character, nor a pair of characters that no piece
has side by side, so texts are cut there. Units between blanks are encoded once for each worker, and the agendas of all new ones
run in step, a round for all of them at a time.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ratestrata.llm.common import Remembered, slices, texts_of

BLANK = "▁"
NEVER = float("inf")
#: A free slot of the table of pairs.
FREE = np.int64(-1)
#: Symbols from which on a text has a heap of its own as agenda.
LONG = 48


class PieceModel:
    """Vocabulary of a model file. Normalisation other than marking blanks, and user-defined pieces, are refused."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        kind, normal = proto.SentencePiece.Type, proto.normalizer_spec
        plain = not normal.precompiled_charsmap and normal.add_dummy_prefix and normal.escape_whitespaces
        if not plain or normal.remove_extra_whitespaces or proto.trainer_spec.model_type != proto.trainer_spec.BPE:
            raise ValueError(f"{path}: only merge-type models without normalisation are supported")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in proto.pieces) or not proto.trainer_spec.byte_fallback:
            raise ValueError(f"{path}: user-defined or unused pieces, or no byte pieces")
        self.end = proto.trainer_spec.eos_id
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kind.NORMAL}
        self.costs = {p.piece: -p.score for p in proto.pieces if p.type == kind.NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kind.BYTE}
        self.surfaces = [
            bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE
            else proto.trainer_spec.unk_surface.encode() if p.type == kind.UNKNOWN
            else p.piece.replace(BLANK, " ").encode() if p.type == kind.NORMAL else b""
            for p in proto.pieces
        ]
        written = [b"%d " % i for i in range(len(self.surfaces))]
        self.number_sizes = np.array([len(x) for x in written])
        self.numbers = np.array([list(x.ljust(8)) for x in written], np.uint8)
        self.leading = {i for piece, i in self.ids.items() if piece.startswith(BLANK)}
        self.pairs = {pair for piece in self.ids for pair in zip(piece, piece[1:])}
        if any(b == BLANK and a != BLANK for a, b in self.pairs):
            raise ValueError(f"{path}: pieces that hold a blank inside")
        # symbols are numbered: pieces by their id, other characters of pieces above, and characters in no piece below zero
        self.size = len(proto.pieces)
        others = sorted({c for piece in self.ids for c in piece} - self.ids.keys())
        number = self.ids | {c: self.size + i for i, c in enumerate(others)}
        self.symbols = -1 - np.arange(0x110000)
        for symbol, n in number.items():
            if len(symbol) == 1:
                self.symbols[ord(symbol)] = n
        self.points = {self.size + i: ord(c) for i, c in enumerate(others)}
        joins = [
            (number[piece[:k]] << 32 | number[piece[k:]], n, self.costs[piece])
            for piece, n in self.ids.items() for k in range(1, len(piece)) if piece[:k] in number and piece[k:] in number
        ]
        # pairs that join, in a table of open addresses, at most a quarter full
        keys, joined, costs = (np.array(x, k) for x, k in zip(zip(*joins), (np.int64, np.int64, np.float64)))
        self.table = np.full(1 << (4 * len(keys)).bit_length(), FREE)
        self.joined, self.join_costs = np.zeros(len(self.table), np.int64), np.zeros(len(self.table))
        place, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = self.table[place[left]] == FREE
            chosen = left[free][np.unique(place[left][free], return_index=True)[1]]
            at = place[chosen]
            self.table[at], self.joined[at], self.join_costs[at] = keys[chosen], joined[chosen], costs[chosen]
            left = np.setdiff1d(left, chosen)
            taken = self.table[place[left]] != FREE
            place[left[taken]] = (place[left[taken]] + 1) & (len(self.table) - 1)
        self.neighbours = np.array(sorted(ord(x) << 21 | ord(y) for x, y in self.pairs), np.int64)
        self.remembered = Remembered(None, 800_000, self.encode_units)

    def _found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Costs of joining pairs of symbols, infinite where no piece results, and the pieces."""
        keys = left << 32 | right
        place = self._slots(keys)
        fits, going = np.zeros(keys.shape, bool), (left >= 0) & (right >= 0)
        while going.any():  # on to the next slot until the pair or a free slot is found
            there = self.table[place]
            fits |= going & (there == keys)
            going &= (there != keys) & (there != FREE)
            place = np.where(going, (place + 1) & (len(self.table) - 1), place)
        return np.where(fits, self.join_costs[place], NEVER), self.joined[place]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed_ = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (len(self.table).bit_length() - 1))
        return mixed_.astype(np.int64)

    def written(self, texts: list[np.ndarray]) -> list[bytes]:
        """The ids of each text in decimal, joined by one space."""
        ids = np.concatenate([*texts, np.zeros(0, np.int64)]).astype(np.int64)
        sizes = self.number_sizes[ids]
        data = self.numbers[ids][np.arange(8) < sizes[:, None]].tobytes()
        cuts = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum([len(x) for x in texts])).astype(np.int64)].tolist()
        return [data[a : max(a, b - 1)] for a, b in zip(cuts, cuts[1:])]

    def _agendas(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The agendas of many texts of one length in step, a row for each: in every round each text joins its best pair, the leftmost among
        equals, and its two new neighbours enter. Symbols of each text in front, and how many they are."""
        n, width = symbols.shape
        left = np.full(n, width)
        if width == 1:
            return symbols, left
        symbols = symbols.copy()
        costs, pieces = self._found(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(n)
        while True:
            best = costs[rows].argmin(axis=1)
            going = costs[rows, best] < NEVER
            rows, best = rows[going], best[going]
            if not len(rows):
                return symbols, left
            new = pieces[rows, best]
            shift = np.arange(width - 1)[None, :] + (np.arange(width - 1)[None, :] > best[:, None])
            kept = symbols[rows]
            kept[:, : width - 1] = np.take_along_axis(kept, np.minimum(shift, width - 1), axis=1)
            kept[np.arange(len(rows)), best] = new
            symbols[rows] = kept
            left[rows] -= 1
            if width > 2:
                # the entry of the pair goes, and those of its neighbours are made anew
                entry = np.arange(width - 2)[None, :] + (np.arange(width - 2)[None, :] >= best[:, None])
                for table, end in ((costs, NEVER), (pieces, 0)):
                    own = table[rows]
                    own[:, : width - 2] = np.take_along_axis(own, entry, axis=1)
                    own[:, width - 2] = end
                    table[rows] = own
            else:
                costs[rows] = NEVER
            for at in (best - 1, best):
                fits = (at >= 0) & (at + 1 < left[rows])
                there, at = rows[fits], at[fits]
                costs[there, at], pieces[there, at] = self._found(symbols[there, at], symbols[there, at + 1])

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units of marked text, one after the other, and how many each has."""
        text = "".join(units)
        if not text:
            return np.zeros(0, np.uint32), np.zeros(len(units), np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        unit_ends = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
        pairs = points[:-1] << 21 | points[1:]
        cut = np.ones(len(points), bool)
        cut[1:] = self.neighbours[np.minimum(np.searchsorted(self.neighbours, pairs), len(self.neighbours) - 1)] != pairs
        cut[unit_ends[unit_ends < len(points)]] = True
        starts = np.flatnonzero(cut)
        lengths = np.diff(np.append(starts, len(points)))
        counts, groups = np.zeros(len(starts), np.int64), []
        for length in np.unique(lengths).tolist():
            chosen = np.flatnonzero(lengths == length)
            for i in range(0, len(chosen), 20_000):
                own = chosen[i : i + 20_000]
                if length < LONG:
                    symbols, left = self._agendas(self.symbols[points[starts[own][:, None] + np.arange(length)]])
                    tokens = symbols[np.arange(length)[None, :] < left[:, None]]
                else:
                    found = [self.agenda(text[a : a + length]) for a in starts[own].tolist()]
                    left, tokens = np.array([len(x) for x in found]), np.concatenate(found)
                counts[own] = left
                groups.append((own, left, tokens))
        begins = np.cumsum(counts) - counts
        out = np.empty(counts.sum(), np.int64)
        for own, left, tokens in groups:
            out[np.repeat(begins[own], left) + np.arange(len(tokens)) - np.repeat(np.cumsum(left) - left, left)] = tokens
        segment_unit = np.searchsorted(unit_ends, starts, "right")
        per_unit = np.bincount(segment_unit, counts, len(units)).astype(np.int64)
        strange = np.flatnonzero((out < 0) | (out >= self.size))
        if len(strange):  # characters that are no piece become their bytes
            point = [self.points[t] if t >= 0 else -1 - t for t in out[strange].tolist()]
            spelled = [[self.bytes[b] for b in chr(c).encode()] for c in point]
            sizes = np.ones(len(out), np.int64)
            sizes[strange] = [len(x) for x in spelled]
            owner = np.repeat(segment_unit, counts)
            longer = np.repeat(out, sizes)
            first = np.cumsum(sizes) - sizes
            for a, ids in zip(first[strange].tolist(), spelled):
                longer[a : a + len(ids)] = ids
            out, per_unit = longer, np.bincount(owner, sizes, len(units)).astype(np.int64)
        return out.astype(np.uint32), per_unit

    def agenda(self, text: str) -> list[int]:
        """Symbols of one text whose blanks are marked, by number."""
        return [self.ids[x] if x in self.ids else int(self.symbols[ord(x)]) for x in self._long(list(text))]

    def _long(self, symbols: list[str | None]) -> list[str]:
        """The agenda as a heap: a long run without a cut has too many rounds for the others to wait."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue: list[tuple[float, int, int, str]] = []

        def propose(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                joined = symbols[left] + symbols[right]
                cost = self.costs.get(joined)
                if cost is not None:
                    heapq.heappush(queue, (cost, left, right, joined))

        for i in range(n - 1):
            propose(i, i + 1)
        while queue:
            _, left, right, joined = heapq.heappop(queue)
            if symbols[left] is None or symbols[right] is None or after[left] != right or symbols[left] + symbols[right] != joined:
                continue  # one of the two has merged meanwhile
            symbols[left], symbols[right] = joined, None
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            propose(before[left], left)
            propose(left, after[left])
        return [symbol for symbol in symbols if symbol is not None]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, the end id last."""
        split = [_units(text) for text in texts]
        return [np.append(ids, np.uint32(self.end)) for ids in self.remembered.encode(split)]

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the text. Byte pieces that make no UTF-8 become replacement characters, one for each byte."""
        text = b"".join(map(self.surfaces.__getitem__, ids))
        if text[:1] == b" " and next((i for i in ids if self.surfaces[i]), None) in self.leading:
            text = text[1:]  # the blank put before every text
        try:
            text.decode()
        except UnicodeDecodeError:
            text = _replaced(text)
        return text


def _replaced(text: bytes) -> bytes:
    out = []
    while text:
        try:
            text.decode()
            return b"".join([*out, text])
        except UnicodeDecodeError as error:
            out += [text[: error.start], "�".encode()]
            text = text[error.start + 1 :]
    return b"".join(out)


def _units(text: str) -> list[str]:
    """A run of marked blanks and what follows up to the next."""
    if not text:
        return []
    marked = BLANK + text.replace(" ", BLANK)
    if BLANK * 2 in marked:
        return re.findall(f"{BLANK}+[^{BLANK}]*", marked)
    return [BLANK + part for part in marked.split(BLANK)[1:]]


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One for each Python worker."""
    return PieceModel(path)


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """`doc_id, ids` of each row of `docs(doc_id, text)`, the end id last. Null text counts as empty: the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = piece_model(model).encode([t or "" for t in batch.column("text").to_pylist()])
            yield pa.record_batch([batch.column("doc_id"), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """`doc_id, text` of `rows(doc_id, ids)`; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else piece_model(model).decode(x).decode() for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    texts_of(rows.withColumn("text", rows["doc_id"].cast("string")))
    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


@lru_cache(maxsize=2)
def library_model(path: str):
    """One for each Python worker."""
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def _agreeing(own: list[list[int]], decoded: list[bytes], wanted: list[list[int]], library: str) -> list[bool]:
    """Whether ids and decoded text of each text are the library's."""
    decode = library_model(library).decode
    return [a == b and text == decode(b).encode() for a, b, text in zip(own, wanted, decoded)]


def round_trip(docs: DataFrame, model: str, library: str | None = None) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256`: ids and their decoded text in one pass, as digests.

    With `library`, a model file that the sentencepiece library reads, also `agrees`: whether the library's ids and decoded text
    of that row, made in the same batch, are the same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own, texts = piece_model(model), [t or "" for t in batch.column("text").to_pylist()]
            found = own.encode(texts)
            ids = [x.tolist() for x in found]
            decoded = [own.decode(x) for x in ids]
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in own.written(found)]),
                "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
            }
            if library is not None:
                wanted = library_model(library).encode(texts, add_eos=True, num_threads=1)
                columns["agrees"] = pa.array(_agreeing(ids, decoded, wanted, library), pa.bool_())
            yield pa.record_batch(list(columns.values()), names=list(columns))

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return texts_of(docs).mapInArrow(run, schema if library is None else f"{schema}, agrees boolean")


def differing(docs: DataFrame, model: str) -> DataFrame:
    """Rows whose ids or decoded text differ from the sentencepiece library's: `doc_id, own, library`. There should be none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            own = [ids.tolist() for ids in piece_model(model).encode(texts)]
            wanted = library_model(model).encode(texts, add_eos=True, num_threads=1)
            agree = _agreeing(own, [piece_model(model).decode(a) for a in own], wanted, model)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(own, pa.list_(pa.int32())), pa.array(wanted, pa.list_(pa.int32()))],
                names=["doc_id", "own", "library"],
            ).filter(pa.array([not x for x in agree]))

    return texts_of(docs).mapInArrow(run, "doc_id long, own array<int>, library array<int>")


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), model, library=model)
