"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

A text is cut before each run of spaces; pieces of the model never hold a space after another character, so no merge crosses a
cut. A unit's merges wait in an agenda by score, then by place. A candidate that is taken from it is skipped when a keyed hash
of seed, document, place of the occurrence and candidate falls below the dropout rate; as in the published method it may come
back when a neighbour merges. So every occurrence of a unit draws its own cut, and a result depends on neither partitioning
nor run. The agendas of a block of occurrences run side by side, a step of each at a time, on arrays; the pieces of a unit's
parts are looked up once and remembered. Units over 48 characters have a heap each.

A character that the model lacks becomes byte pieces, and so does a literal U+2581, which the model would read as a space:
decoding gives every text back exactly.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqlake.llm.common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNIT = re.compile(r" *[^ ]+| +")
NEVER = float("inf")
KEPT = 16_000_000  # parts of units that a task remembers; past it they are looked up anew
WIDTHS = (4, 6, 8, 12, 16, 24, 48)  # characters of the units whose agendas run side by side
SHORT = WIDTHS[-1]
BLOCK = 32_768  # units of a block
GROUP = 262_144  # characters of neighbouring texts that are cut together


@dataclass
class Model:
    """Pieces of a SentencePiece BPE model; bounded by the vocabulary, it travels with the tasks."""

    ids: dict[str, int]
    scores: list[float]
    bytes_of: list[bytes]
    byte_ids: list[int]

    @classmethod
    def load(cls, path: str = MODEL) -> Model:
        """Models without byte pieces, with their own normaliser or with pieces that span words are refused."""
        p = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        plain = [not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i) or p.is_byte(i)) for i in range(len(names))]
        by_byte = {int(names[i][3:5], 16): i for i in range(len(names)) if p.is_byte(i)}
        ids = {n.replace(SPACE, " "): i for i, n in enumerate(names) if plain[i]}
        if len(by_byte) != 256 or any(" " in n.lstrip(" ") for n in ids):
            raise ValueError("the model needs all byte pieces, and no piece may hold a space after another character")
        value = [bytes([int(n[3:5], 16)]) if p.is_byte(i) else n.replace(SPACE, " ").encode() if plain[i] else b"" for i, n in enumerate(names)]
        return cls(ids, [p.get_score(i) for i in range(len(names))], value, [by_byte[b] for b in range(256)])


def place(left: int, stop: int) -> int:
    return left * 0x9E3779B97F4A7C15 + stop * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF


def skipped(key: int, left: int, stop: int, below: int) -> bool:
    """Whether the candidate from ``left`` to ``stop`` is skipped; 28 bits of a hash against the rate."""
    h = key ^ place(left, stop)
    return (h ^ h >> 31) * 0xD6E8FEB86659FD93 >> 36 & 0xFFFFFFF < below


class Encoder:
    def __init__(self, model: Model, dropout: float, seed: int, variants: int | None = None) -> None:
        """``variants`` limits the draws of a unit to so many keys; None: each occurrence has its own."""
        self.model, self.seed, self.variants = model, seed, variants
        self.skip_below = int(dropout * 2**28)
        self.ranks = {piece: -model.scores[i] for piece, i in model.ids.items()}  # lowest merges first
        self.cost = np.array([*(-score for score in model.scores), NEVER], np.float32)  # of a piece by id, a float of the model; the last for none
        self.byte_ids = np.array(model.byte_ids, np.int32)
        tree: dict[int, int] = {}  # the pieces by their characters: node and character -> node
        ends = {}
        for piece, i in model.ids.items():
            node = 0
            for c in piece:
                node = tree.setdefault(node << 21 | ord(c), len(tree) + 1)
            ends[node] = i
        self.edges = np.array(sorted(tree), np.int64)
        self.children = np.array([tree[edge] for edge in self.edges.tolist()], np.int64)
        self.piece_at = np.array([ends.get(node, -1) for node in range(len(tree) + 1)], np.int32)
        self.forget()

    def forget(self) -> None:
        """Begin the tables of the units' parts anew."""
        self.known: dict[str, int] = {}  # where a unit's table begins
        self.parts, self.used = np.empty(4096, np.int32), 0

    def unit(self, unit: str, key: int, taken: list[int] | None = None) -> tuple[int, ...]:
        """Ids of one occurrence by itself: the agenda, with candidates skipped by hash; with ``taken`` none is, and it gets the places."""
        ids, ranks, below = self.model.ids, self.ranks, self.skip_below if taken is None else 0
        ends = (self.short if len(unit) <= 48 else self.long)(unit, ranks, below, key, taken)
        out, at = [], 0
        for end in ends:
            symbol = unit[at:end]
            piece = ids.get(symbol)
            if piece is None or symbol == SPACE:
                out.extend(self.model.byte_ids[b] for b in symbol.encode())
            else:
                out.append(piece)
            at = end
        return tuple(out)

    @staticmethod
    def short(unit: str, ranks: dict[str, float], below: int, key: int, taken: list[int] | None = None) -> list[int]:
        """Ends of the symbols; the agenda is a list with one entry per neighbouring pair, the leftmost best is taken."""
        cut = list(range(len(unit) + 1))  # where symbols begin, and the end
        cost = [ranks.get(unit[i:i + 2], NEVER) for i in range(len(unit) - 1)]
        while cost:
            best = min(cost)
            if best == NEVER:
                break
            i = cost.index(best)
            if below and skipped(key, cut[i], cut[i + 2], below):
                cost[i] = NEVER
                continue
            if taken is not None:
                taken.append(place(cut[i], cut[i + 2]))
            del cut[i + 1], cost[i]
            if i < len(cost):
                cost[i] = ranks.get(unit[cut[i]:cut[i + 2]], NEVER)
            if i:
                cost[i - 1] = ranks.get(unit[cut[i - 1]:cut[i + 1]], NEVER)
        return cut[1:]

    @staticmethod
    def long(unit: str, ranks: dict[str, float], below: int, key: int, taken: list[int] | None = None) -> list[int]:
        """As ``short`` with a heap, for units without an early end."""
        n = len(unit)
        end = list(range(1, n + 1))  # of the symbol that starts here; 0: no symbol starts here
        before = list(range(-1, n - 1))
        agenda: list[tuple[float, int, int, int]] = []

        def propose(left: int, right: int) -> None:
            cost = ranks.get(unit[left:end[right]])
            if cost is not None:
                heapq.heappush(agenda, (cost, left, right, end[right]))

        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            _, left, right, stop = heapq.heappop(agenda)
            if end[left] != right or end[right] != stop:  # one of the two has merged meanwhile
                continue
            if below and skipped(key, left, stop, below):
                continue
            if taken is not None:
                taken.append(place(left, stop))
            end[left], end[right] = stop, 0
            if stop < n:
                before[stop] = left
                propose(left, stop)
            if before[left] >= 0:
                propose(before[left], left)
        return [e for e in end if e]

    def learn(self, units: list[str]) -> None:
        """Keep the piece of every part of new units, by end, then start: its id, -1 for none, and -2 - c for a character c without.

        The parts that begin at a character are followed in the tree of pieces, those of all units together, as far as it goes.
        """
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        rows = sizes * (sizes + 1) // 2
        tables = self.used + np.cumsum(rows) - rows
        self.used += int(rows.sum())
        if self.used > len(self.parts):
            self.parts = np.concatenate([self.parts, np.empty(self.used, np.int32)])
        self.parts[tables[0]:self.used] = -1
        self.known.update(zip(units, tables.tolist(), strict=True))
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.repeat(sizes, sizes)
        start = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # of a character in its unit
        at = np.repeat(tables, sizes) + start * (start + 3) // 2  # of the part that is this character alone
        live, node, depth, ends = np.arange(len(points)), np.zeros(len(points), np.int64), 0, at.copy()
        while len(live):
            step = node << 21 | points[live + depth]
            edge = np.minimum(np.searchsorted(self.edges, step), len(self.edges) - 1)
            there = self.edges[edge] == step
            live, node = live[there], self.children[edge[there]]
            self.parts[ends[live]] = self.piece_at[node]
            depth += 1
            ends[live] += start[live] + depth  # the same start, one character more
            more = start[live] + depth < size[live]
            live, node = live[more], node[more]
        alone = (self.parts[at] < 0) | (points == ord(SPACE))
        self.parts[at[alone]] = -2 - points[alone]

    def agendas(self, tables: np.ndarray, sizes: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The agendas of many occurrences side by side, one step of each at a time: (occurrence, start, part) of all symbols.

        The cheapest neighbours of an occurrence, the leftmost of equals, are merged, or skipped if the hash of its draw says so.
        """
        rows, width = len(tables), int(sizes.max())
        ending = np.arange(width + 1) * np.arange(-1, width) // 2  # parts that end earlier

        def part(who: np.ndarray, left: np.ndarray, stop: np.ndarray) -> np.ndarray:
            return self.parts[tables[who] + ending[stop] + left]

        def price(who: np.ndarray, left: np.ndarray, stop: np.ndarray) -> np.ndarray:
            return self.cost[np.maximum(part(who, left, stop), -1)]  # -1 is the last place, that of no piece

        places = np.arange(width + 1)
        end = np.where(places < sizes[:, None], places + 1, 0)  # of the symbol that starts here; 0: none starts here
        start = np.broadcast_to(places - 1, (rows, width + 1)).copy()  # of the symbol that ends here
        cost = np.full((rows, width), NEVER, np.float32)  # of a symbol with its right neighbour
        who, left = np.nonzero(places[:width] < sizes[:, None] - 1)
        cost[who, left] = price(who, left, left + 2)
        who = np.arange(rows)
        while True:
            left = cost[who].argmin(axis=1)
            open_ = cost[who, left] < NEVER
            who, left = who[open_], left[open_]
            if not len(who):
                break
            right = end[who, left]
            stop = end[who, right]
            h = draws[who] ^ (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + stop.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
            skip = (h ^ h >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(36) < np.uint64(self.skip_below)
            cost[who[skip], left[skip]] = NEVER
            w, i, j, k = (x[~skip] for x in (who, left, right, stop))
            end[w, i], end[w, j], start[w, k] = k, 0, i
            cost[w, i] = cost[w, j % width] = NEVER
            more = k < sizes[w]
            cost[w[more], i[more]] = price(w[more], i[more], end[w[more], k[more]])
            more = i > 0
            before = start[w[more], i[more]]
            cost[w[more], before] = price(w[more], before, k[more])
        who, left = np.nonzero(end[:, :width])
        return who, left, part(who, left, end[who, left])

    def draws(self, units: list[str], key: str) -> np.ndarray:
        """The keys of a text's units, by seed, document and place."""
        x = np.arange(len(units), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(xxhash.xxh64_intdigest(f"{self.seed}:{key}"))
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        if self.variants is None:
            return x
        few = (x % np.uint64(self.variants)).tolist()
        return np.array([xxhash.xxh64_intdigest(f"{self.seed}:{d}:{u}") for d, u in zip(few, units, strict=True)], dtype=np.uint64)

    def block(self, units: list[str], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units, one after the other, and how many each has."""
        if self.used > KEPT:
            self.forget()
        known = self.known
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        tables = np.fromiter(map(known.get, units, repeat(-1)), np.int64, len(units))
        new = np.flatnonzero((tables < 0) & (sizes <= SHORT)).tolist()
        if new:
            self.learn(list(dict.fromkeys(units[i] for i in new)))
            tables[new] = [known[units[i]] for i in new]
        first = np.cumsum(sizes) - sizes
        flat = np.full(int(sizes.sum()), -1, np.int32)  # the symbol that starts at a character; -1: none does
        low = 0
        for width in WIDTHS:
            chosen = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            if len(chosen):
                who, left, symbols = self.agendas(tables[chosen], sizes[chosen], draws[chosen])
                flat[first[chosen][who] + left] = symbols
        for i in np.flatnonzero(sizes > SHORT).tolist():
            unit, at = units[i], 0
            for end in self.long(unit, self.ranks, self.skip_below, int(draws[i])):
                piece = self.model.ids.get(unit[at:end])
                flat[first[i] + at] = -2 - ord(unit[at]) if piece is None else piece
                at = end
        owner = np.repeat(np.arange(len(units)), sizes)[flat != -1]
        flat = flat[flat != -1]
        lacking = flat < 0
        if not lacking.any():
            return flat, np.bincount(owner, minlength=len(units))
        points = -2 - flat[lacking]
        ids_of = np.ones(len(flat), np.int64)
        ids_of[lacking] = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        out, as_bytes = np.repeat(flat, ids_of), np.repeat(lacking, ids_of)
        out[as_bytes] = self.byte_ids[np.frombuffer("".join(map(chr, points.tolist())).encode(), np.uint8)]
        return out, np.bincount(np.repeat(owner, ids_of), minlength=len(units))

    def texts(self, texts: list[str], keys: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, whose units share blocks."""
        units: list[str] = []
        draws, ends = [], []
        for text, key in zip(texts, keys, strict=True):
            found = UNIT.findall(" " + text) if text else []
            draws.append(self.draws(found, key))
            units += found
            ends.append(len(units))
        if not units:
            return [np.empty(0, np.int32) for _ in texts]
        drawn = np.concatenate(draws)
        blocks = [self.block(units[i:i + BLOCK], drawn[i:i + BLOCK]) for i in range(0, len(units), BLOCK)]
        before = np.concatenate([[0], np.cumsum(np.concatenate([counts for _, counts in blocks]))])
        return np.split(np.concatenate([ids for ids, _ in blocks]), before[ends[:-1]])

    def text(self, text: str, key: str) -> list[int]:
        return self.texts([text], [key])[0].tolist()


def encode(
    docs: DataFrame, model: str = MODEL, dropout: float = 0.1, seed: int = 7, variants: int | None = None,
    id_col: str = "doc_id", text_col: str = "text", ids_col: str = "ids",
) -> DataFrame:
    """``docs`` with the piece ids of ``text_col`` in ``ids_col`` (array of int; a column of that name is replaced).

    Null text gives null, empty text no ids. Every occurrence of a word draws a cut of its own, unless ``variants`` limits
    the draws. Documents that share an id draw alike, as do all rows without id, so repeated rows get equal ids. With ``dropout`` 0 the ids are the model's own. An empty table gives an empty table. Texts are
    worked on one by one, whole; a batch leaves as soon as it holds a million ids.
    """
    rows = docs.drop(ids_col)
    loaded = Model.load(model)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(loaded, dropout, seed, variants)
        for batch in batches:
            texts, keys = batch.column(names.index(text_col)), batch.column(names.index(id_col)).to_pylist()
            start, found, group, held, size = 0, [], [], 0, 0
            for i in range(len(keys)):
                text = texts[i].as_py()
                group.append(text)
                size += len(text or "")
                if size < GROUP and i < len(keys) - 1:
                    continue
                there = [j for j, text in enumerate(group) if text is not None]
                first = i + 1 - len(group)
                cuts = dict(zip(there, encoder.texts([group[j] for j in there], [str(keys[first + j]) for j in there]), strict=True))
                found += [cuts.get(j) for j in range(len(group))]
                held += sum(map(len, cuts.values()))
                group, size = [], 0
                if held > 1_000_000 or i == len(keys) - 1:
                    column = pa.array(found, pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([*batch.slice(start, i + 1 - start).columns, column], [*names, ids_col])
                    start, found, held = i + 1, [], 0

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, model: str = MODEL, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``rows`` with the text of ``ids_col`` in ``text_col`` (replaced if there): null gives null, no ids the empty text.

    Ids of control pieces stand for nothing. An id outside the vocabulary, or bytes that are no UTF-8, stop the job.
    """
    rest = rows.drop(text_col)
    value = Model.load(model).bytes_of
    names = rest.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for ids in batch.column(names.index(ids_col)):
                if not ids.is_valid:
                    texts.append(None)
                    continue
                numbers = ids.values.to_numpy(zero_copy_only=False)
                if len(numbers) and (numbers.min() < 0 or numbers.max() >= len(value)):
                    raise ValueError("an id is not in the vocabulary")
                texts.append(b"".join(map(value.__getitem__, numbers.tolist())).decode().removeprefix(" "))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, text_col])

    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField(text_col, T.StringType())]))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts to ids and back; the ids by number and digest, the text by digests before and after."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = encode(docs).withColumn("sha", F.sha2("text", 256))
    shown = ids.select("doc_id", "sha", F.size("ids").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), "ids")
    back = decode(shown, text_col="decoded")
    return back.select("doc_id", "n_ids", "ids_hash", F.sha2("decoded", 256).alias("decoded_sha256"), (F.sha2("decoded", 256) == F.col("sha")).alias("lossless"))
