"""Encoding and decoding with a SentencePiece BPE vocabulary, by vectorised merge rounds.

A text becomes one string with U+2581 for each space and one more in front. No piece holds U+2581 after another
character, so merges never cross such a place and the text falls into independent segments, which are also cut around
characters that occur in no longer piece. The distinct segments of a batch that have no ids yet are laid out in one flat
numpy array of symbols; each round finds the best-ranked adjacent pair of every segment with a segmented minimum,
merges its leftmost non-overlapping occurrences in all segments at once, and compacts the array, until no pair is left.
Occurrences of one segment are merged together only if none of the pairs that this makes would have come before the
later occurrences; otherwise only the leftmost is merged, which keeps the order of the library's queue.

A null text counts as empty: begin and end id only. Rows are independent, so ties and repeated rows need no rule. An
empty table gives no rows. Very long texts are encoded whole; a batch holds one of them at a time, and long segments are
not remembered. Columns besides the id, the text and those to keep are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .text import documents, slices

SPACE = "▁"
NONE = np.int64(1) << 40
#: Segments whose ids a task remembers, and their greatest length. A segment takes some 250 bytes.
REMEMBERED, LONGEST = 100_000, 64
#: Bytes of text encoded in one go: lists and arrays take many times as much.
PART = 256 << 10


class Pieces:
    """The tables of one vocabulary, made on the driver from the model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(n)]
        self.size, self.begin, self.end = n, model.bos_id(), model.eos_id()
        self.byte_id = np.zeros(256, np.int64)
        for i in range(n):
            if model.is_byte(i):
                self.byte_id[int(names[i][1:-1], 16)] = i
        self.ids = {p: i for i, p in enumerate(names) if not special[i]}
        scores = {i: model.get_score(i) for i in self.ids.values()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        left, right, out, rank = [], [], [], []
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                if (a := self.ids.get(p[:cut])) is not None and (b := self.ids.get(p[cut:])) is not None:
                    left.append(a), right.append(b), out.append(i), rank.append(order[scores[i]])
        key = np.array(left, np.int64) * n + np.array(right, np.int64)
        self.out, self.rank = np.append(np.array(out, np.int64), -1), np.append(np.array(rank, np.int64), NONE)
        self._hash(key)
        single = {ord(p): i for p, i in self.ids.items() if len(p) == 1}
        self.char_id = np.full(max(single) + 2, -1, np.int64)
        self.char_id[list(single)] = list(single.values())
        self.chars = {c for p in self.ids if len(p) > 1 for c in p}
        shown = [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else p.encode() for i, p in enumerate(names)]
        self.length = np.array([len(b) for b in shown], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.blob = np.frombuffer(b"".join(shown), np.uint8)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces with U+2581 after another character can't be cut into segments")

    def _hash(self, key: np.ndarray) -> None:
        """Tables of pairs by two multiplicative hashes: the second has the pairs that share a slot of the first."""
        self.pairs, self.tables = np.append(key, -1), []
        rest = np.arange(len(key))
        for bits in (21, 17, 15, 13):
            table = np.full(1 << bits, len(key), np.int32)
            slots = self._slot(key[rest], bits)
            table[slots] = rest
            self.tables.append((bits, table))
            rest = rest[table[slots] != rest]
        if len(rest):
            raise ValueError(f"{len(rest)} pairs of pieces found no slot")

    @staticmethod
    def _slot(key: np.ndarray, bits: int) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * bits)) >> np.uint64(64 - bits)).astype(np.int64)

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair of symbols; NONE where no piece holds both. Symbols below 0 are unknown characters."""
        key = np.where((a < 0) | (b < 0), np.int64(self.size) * self.size, a * self.size + b)
        none = len(self.pairs) - 1
        found = np.full(len(key), none, np.int64)
        for bits, table in self.tables:
            at = table[self._slot(key, bits)]
            found = np.where(self.pairs[at] == key, at, found)
        return self.rank[found], self.out[found]

    def encode_segments(self, segments: list[str]) -> list[bytes]:
        """The ids of each segment, as little-endian unsigned 32-bit integers."""
        counts = np.array([len(s) for s in segments], np.int64)
        text = "".join(segments)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        symbols = self.char_id[np.minimum(points, len(self.char_id) - 1)]
        symbols = np.where(symbols < 0, -1 - points, symbols)
        owner = np.repeat(np.arange(len(segments)), counts)
        rank, made = self._pairs(symbols, owner, np.arange(len(symbols)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.minimum.reduceat(rank, starts)
            if (best == NONE).any():
                over = np.repeat(best == NONE, sizes)
                done.append((owner[over], symbols[over]))
                symbols, owner, rank, made = symbols[~over], owner[~over], rank[~over], made[~over]
                sizes, best = sizes[best < NONE], best[best < NONE]
                if not len(symbols):
                    break
            # leftmost first: in a run of overlapping occurrences, every second one counts
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            first = np.append(True, np.diff(at) > 1)
            runs = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - runs) % 2 == 0]
            mine = owner[at]
            leads = np.append(True, mine[1:] != mine[:-1])
            if not leads.all():
                at = self._ordered(symbols, owner, made, rank, at, mine, leads)
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, owner, rank, made = symbols[keep], owner[keep], rank[keep], made[keep]
            at -= np.arange(len(at))
            changed = np.concatenate([at, at[at > 0] - 1])
            rank[changed], made[changed] = self._pairs(symbols, owner, changed)
        return self._collected(len(segments), done)

    def _pairs(self, symbols, owner, at):
        """Rank and result of the pairs that start at the given places."""
        n = len(symbols)
        after = np.minimum(at + 1, n - 1)
        return self.look(symbols[at], np.where((at + 1 < n) & (owner[after] == owner[at]), symbols[after], -1))

    def _ordered(self, symbols, owner, made, rank, at, mine, leads):
        """Drops occurrences that the queue might reach only after a pair made by an earlier one."""
        n = len(symbols)
        after = np.minimum(at + 2, n - 1)
        right = np.where((at + 2 < n) & (owner[after] == mine), symbols[after], -1)
        r_right, _ = self.look(made[at], right)
        merged_left = np.append(False, (at[1:] == at[:-1] + 2) & (mine[1:] == mine[:-1]))
        before = np.maximum(at - 1, 0)
        left = np.where((at > 0) & (owner[before] == mine), symbols[before], -1)
        left = np.where(merged_left, np.append(-1, made[at[:-1]]), left)
        r_left, _ = self.look(left, made[at])
        unsafe = np.minimum(r_right, r_left) <= rank[at]
        if not unsafe.any():
            return at
        group = np.cumsum(leads) - 1
        bad = np.zeros(group[-1] + 1, bool)
        bad[group[unsafe]] = True
        return at[leads | ~bad[group]]

    def _collected(self, n: int, done) -> list[bytes]:
        if not done:
            return [b""] * n
        owner, symbols = np.concatenate([x[0] for x in done]), np.concatenate([x[1] for x in done])
        by = np.argsort(owner, kind="stable")
        owner, symbols = owner[by], symbols[by]
        if (symbols < 0).any():  # unknown characters become bytes
            out_owner, out = [], []
            for w, s in zip(owner.tolist(), symbols.tolist()):
                for i in [s] if s >= 0 else [int(self.byte_id[b]) for b in chr(-1 - s).encode()]:
                    out_owner.append(w), out.append(i)
            owner, symbols = np.array(out_owner), np.array(out)
        cuts = np.searchsorted(owner, np.arange(n + 1)) * 4
        raw = symbols.astype("<u4").tobytes()
        return [raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8, as the library's decode gives it for ids of valid texts."""
        lengths = self.length[ids]
        shift = self.start[ids] - (np.cumsum(lengths) - lengths)
        raw = self.blob[np.repeat(shift, lengths) + np.arange(lengths.sum())].tobytes()
        raw = raw.replace(SPACE.encode(), b" ")
        return raw[1:] if raw[:1] == b" " else raw


class Encoder:
    """Encodes texts; remembers the ids of segments that it has met."""

    def __init__(self, pieces: Pieces):
        import re

        self.pieces, self.known = pieces, {}
        usual = "".join(re.escape(c) for c in sorted(pieces.chars - {SPACE}))
        self.cut = re.compile(f"{SPACE}*[{usual}]+|{SPACE}+|[^{SPACE}{usual}]").findall

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with begin and end, as bytes."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        cut = [self.cut(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = list(set().union(*cut).difference(self.known))
        self.known.update(zip(new, self.pieces.encode_segments(new)))
        begin, end = (int(i).to_bytes(4, "little") for i in (self.pieces.begin, self.pieces.end))
        out = [begin + b"".join(map(self.known.__getitem__, s)) + end for s in cut]
        for segment in new:
            if len(segment) > LONGEST:
                del self.known[segment]
        return out


def encoded(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row: id, the columns named in keep, ids (array of int) and decoded, the text that the ids give back."""
    keep = [c for c in keep or () if c not in ("ids", "decoded", id_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces)
        for b in slices(batches, "_text", PART):
            raw = encoder([t or "" for t in b.column("_text").to_pylist()])
            ids = [np.frombuffer(r, "<u4").astype(np.int32) for r in raw]
            decoded = [pieces.decode(i).decode("utf-8", "replace") for i in ids]
            made = [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in (id_col, *keep)] + made, [id_col, *keep, "ids", "decoded"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (id_col, *keep))
    return docs.select(id_col, *keep, docs[text_col].cast("string").alias("_text")).mapInArrow(run, f"{fields}, ids array<int>, decoded string")


def digests(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, without sending the ids through Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces)
        for b in slices(batches, "text", PART):
            raw = encoder([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([len(r) // 4 for r in raw], pa.int64()),
                    pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
                    pa.array([hashlib.sha256(pieces.decode(np.frombuffer(r, "<u4"))).hexdigest() for r in raw], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), Pieces(default_model()))
