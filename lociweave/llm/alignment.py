"""Operator 13: tokens of two tokenisers aligned by the bytes that they cover.

Side A is a byte-level tokeniser over a blank and the text, side B a piece tokeniser that adds the blank itself.
Where tokens of both end at one byte, a group ends, and the two last tokens are linked.

1. Arrow functions encode blocks of texts. A text is cut into units before blanks between two other characters: there both
   tokenisers begin a token (A's pattern always, B where no piece has a blank after another character, which is looked up), so the
   groups of a text are those of its units in order. A unit that is new to the worker is encoded by both sides, and a
   two-pointer merge of the cumulative ends of its tokens emits groups and links. Per document go out its digest
   and its links as places in the block's list of id pairs; per block goes out that list with counts. All is written once to the shared folder.
2. Spark adds the blocks' counts up by pair, takes the highest of each B id, and joins both back to the blocks'
   lists, so what is shuffled is a block's different pairs and not its links.
3. Documents meet the list of their block in a cogroup, which BLOCK_CHARS bounds, and add up its counts along their links.

Input cases: null and empty texts, and texts whose tokens don't give back their bytes (U+2581 reads as a blank) have no tokens: zeros
and an empty digest; strings of special tokens are plain text; repeated rows count each time; null doc_ids stay; an empty
table gives an empty result; other columns are ignored; ties for a B id's highest count are all best. A text longer than
a block is a block of its own. Neither vocabulary has a token without bytes, so at most one token of a side ends at a place.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table
from .token_counts import load_tokenizer, text_groups

BLOCK_CHARS = 2_000_000
CACHE_CHARS = 24_000_000  # of units and their groups that a worker keeps from one block to the next
JOINED = 1000  # units that are encoded as one text
LEAD = " a"  # stands before units that are encoded, so that each follows another character
_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: The pattern of side A, under which a blank or line feed after another character begins a token.
PATTERN = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


def byte_of_letter() -> dict[str, int]:
    """The byte that each visible letter of a byte-level vocabulary stands for: printable ones for themselves, the others in order from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """Side A; a text is given with its blank."""

    def __init__(self, file: str) -> None:
        self.tokenizer = load_tokenizer(file)
        self.tokenizer.encode_special_tokens = True
        letters = byte_of_letter()
        vocabulary = sorted((i, t) for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items())
        self.bytes = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for i, t in vocabulary}
        known = json.loads(self.tokenizer.to_str())
        self.cuts = known["normalizer"] is None and known["pre_tokenizer"] == PATTERN

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Side B; it adds the blank itself, so the first character of a text goes."""

    def __init__(self, file: str) -> None:
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=public_tokenizers.path(file))
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = {i: bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)}
        self.cuts = not any(re.search("\n|[^▁]▁", p) for p in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t[1:] for t in texts], num_threads=1)


def merged(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """How many tokens of either side lie up to each place where both end: two pointers over cumulative ends."""
    upto_a, upto_b = [], []
    i = j = 0
    while i < len(a):
        if a[i] < b[j]:
            i += 1
        elif b[j] < a[i]:
            j += 1
        else:
            i, j = i + 1, j + 1
            upto_a.append(i)
            upto_b.append(j)
    return upto_a, upto_b


class Aligner:
    """Units that were met, each with its numbers of tokens and groups, its groups as bytes, and its links as places in a list of pairs."""

    def __init__(self, a_file: str, b_file: str) -> None:
        self.a, self.b = ByteLevel(a_file), Pieces(b_file)
        self.cuts = self.a.cuts and self.b.cuts
        self.lengths = [np.array([len(side.bytes.get(i, b"")) for i in range(max(side.bytes) + 1)]) for side in (self.a, self.b)]
        self.written = [np.array([[b"%d%s" % (i, end) for i in range(max(side.bytes) + 1)] for end in (b",", last)], object) for side, last in ((self.a, b"|"), (self.b, b";"))]
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[bytes] = []  # each ends with `;`
        self.pair_place: dict[int, int] = {}
        self.pairs = array("q")  # A id in the upper 32 bits, B id in the lower
        self.sizes = array("q")  # four numbers a unit: tokens of A and B, groups, faithful
        self.links, self.begins = array("q"), array("q", [0])
        self.chars = 0

    def units(self, text: str) -> list[str]:
        text = " " + text
        if not self.cuts:
            return [text]
        words = text.split()
        if sum(map(len, words)) + len(words) == len(text) and text.count(" ") + text.count("\n") == len(words) and "\0" not in text:
            return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]  # one blank before each word
        return _BOUNDARY.split(text)

    def add(self, units: list[str]) -> None:
        """Many units are encoded as one text; one that may not give back its bytes, ends with a blank or is long is encoded alone."""
        together = [u for u in units if self.cuts and len(u) <= 256 and not u[-1].isspace() and "▁" not in u]
        alone = set(units).difference(together)
        runs = [together[k : k + JOINED] for k in range(0, len(together), JOINED)] + [[u] for u in sorted(alone)]
        first = LEAD if self.cuts else ""
        for k in range(0, len(runs), 64):
            texts = [first + "".join(run) for run in runs[k : k + 64]]
            for run, text, a, b in zip(runs[k : k + 64], texts, self.a.encode(texts), self.b.encode(texts), strict=True):
                if not self.note(run, text, a, b, len(first)) and len(run) > 1:
                    for unit in run:
                        ((one,), (two,)) = self.a.encode([first + unit]), self.b.encode([first + unit])
                        self.note([unit], first + unit, one, two, len(first))

    def note(self, units: list[str], text: str, a: list[int], b: list[int], skip: int) -> bool:
        """Enter units whose text, after `skip` bytes, has these tokens; False, and several units are not entered, if the tokens don't give back the bytes."""
        raw = text.encode()
        if not b"".join(map(self.a.bytes.__getitem__, a)) == raw == b"".join(map(self.b.bytes.__getitem__, b)):
            if len(units) == 1:
                self.enter(units, np.zeros((1, 4), np.int64), [b""], np.zeros(0, np.int64), np.zeros(1, np.int64))
            return False
        a_ids, b_ids = np.array(a), np.array(b)
        a_ends, b_ends = np.cumsum(self.lengths[0][a_ids]), np.cumsum(self.lengths[1][b_ids])
        upto_a, upto_b = (np.array(x) for x in merged(a_ends.tolist(), b_ends.tolist()))
        group_ends = a_ends[upto_a - 1]
        borders = np.cumsum([skip, *(len(u.encode()) for u in units)])
        at = np.searchsorted(group_ends, borders, "right")
        if not np.array_equal(borders[borders > 0], group_ends[at[borders > 0] - 1]):
            raise ValueError("the tokenisers don't part between units")
        pairs = a_ids[upto_a - 1] << 32 | b_ids[upto_b - 1]
        i, j = np.arange(len(a_ids)), np.arange(len(b_ids))
        of_a, of_b = np.searchsorted(upto_a, i, "right"), np.searchsorted(upto_b, j, "right")
        every = np.empty(len(i) + len(j), object)
        every[i + np.concatenate([[0], upto_b])[of_a]] = self.written[0][(upto_a[of_a] == i + 1).astype(int), a_ids]
        every[j + upto_a[of_b]] = self.written[1][(upto_b[of_b] == j + 1).astype(int), b_ids]
        every = every.tolist()
        n_a, n_b = (np.concatenate([[0], x])[at] for x in (upto_a, upto_b))
        cut = (n_a + n_b).tolist()
        groups = [b"".join(every[x:y]) for x, y in zip(cut, cut[1:], strict=False)]
        sizes = np.stack([np.diff(n_a), np.diff(n_b), np.diff(at), np.ones(len(units), np.int64)], axis=1)
        self.enter(units, sizes, groups, pairs[at[0] :], np.diff(at))
        return True

    def enter(self, units: list[str], sizes: np.ndarray, groups: list[bytes], pairs: np.ndarray, n: np.ndarray) -> None:
        self.place.update(zip(units, range(len(self.groups), len(self.groups) + len(units)), strict=True))
        self.groups += groups
        self.sizes.frombytes(sizes.astype(np.int64).tobytes())
        known, own = self.pair_place, pairs.tolist()
        new = [x for x in dict.fromkeys(own) if x not in known]
        known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        self.pairs.extend(new)
        self.begins.frombytes((len(self.links) + np.cumsum(n)).astype(np.int64).tobytes())
        self.links.extend(map(known.__getitem__, own))
        self.chars += sum(map(len, units)) + sum(map(len, groups))

    def of(self, texts: list[str]) -> list[list[int]]:
        """The places of each text's units; all of them are known afterwards."""
        if self.chars > CACHE_CHARS:
            self.forget()
        cut = [self.units(t) if t else [] for t in texts]
        missing: set[str] = set()
        for units in cut:
            missing.update(units)
        missing.difference_update(self.place)
        self.add(sorted(missing))
        return [list(map(self.place.__getitem__, units)) for units in cut]


@lru_cache(1)
def aligner_of(a: str, b: str) -> Aligner:
    """A worker keeps its units from one task to the next."""
    return Aligner(a, b)


def token_groups(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, n_a, n_b, groups for each row; groups as `a1,a2|b1;a3|b2,b3`."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(a, b)
        for batch in batches:
            at = 0
            for run in text_groups([t or "" for t in batch.column(1).to_pylist()], BLOCK_CHARS):
                n_a, n_b, groups = [], [], []
                for places in aligner.of(run):
                    sizes = [aligner.sizes[4 * p : 4 * p + 4] for p in places]
                    good = all(s[3] for s in sizes)
                    n_a.append(sum(s[0] for s in sizes) if good else 0)
                    n_b.append(sum(s[1] for s in sizes) if good else 0)
                    groups.append(b"".join(aligner.groups[p] for p in places)[:-1].decode() if good else "")
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + len(run)], pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(groups)], ["doc_id", "n_a", "n_b", "groups"])
                at += len(run)

    return docs.select("doc_id", "text").mapInArrow(align, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, groups string")


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def blocks_of(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Rows of documents (block, doc_id, numbers, digest, links: places in the block's pairs) and of blocks (block, pairs, times), written once."""
    kind = docs.schema["doc_id"].dataType

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block = aligner_of(a, b), TaskContext.get().partitionId() << 32
        for batch in batches:
            at = 0
            for run in text_groups([t or "" for t in batch.column(1).to_pylist()], BLOCK_CHARS):
                cut = aligner.of(run)
                sizes = np.frombuffer(aligner.sizes, np.int64).reshape(-1, 4)
                links, begins, pairs = (np.frombuffer(x, np.int64) for x in (aligner.links, aligner.begins, aligner.pairs))
                numbers, digests, found = [], [], []
                for places in cut:
                    own = sizes[places]
                    if not places or not own[:, 3].all():
                        numbers.append((0, 0, 0))
                        digests.append("")
                        found.append(np.zeros(0, np.int64))  # no view of links, which would outlive the block
                        continue
                    numbers.append(own[:, :3].sum(0))
                    digests.append(hashlib.sha256(b"".join([aligner.groups[p] for p in places])[:-1]).hexdigest())
                    first, n = begins[places], begins[np.array(places) + 1] - begins[places]
                    found.append(links[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())])
                every = np.concatenate(found)
                times = np.bincount(every, minlength=len(pairs))
                held = np.flatnonzero(times)
                local = np.zeros(len(pairs), np.int32)
                local[held] = np.arange(len(held))
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                n, total = len(run), np.array(numbers, np.int64).reshape(-1, 3)
                columns = [
                    pa.array(np.append(np.full(n, block), block)),
                    pa.concat_arrays([batch.column(0)[at : at + n], pa.nulls(1, batch.column(0).type)]),
                    *(pa.concat_arrays([pa.array(total[:, k]), pa.nulls(1, pa.int64())]) for k in (0, 1, 2)),
                    pa.array(np.append(np.diff(ends), 0), pa.int64()),
                    pa.array([*digests, None], pa.string()),
                    pa.ListArray.from_arrays(pa.array([*ends[:-1].tolist(), None, int(ends[-1])], pa.int32()), pa.array(local[every])),
                    pa.array([*[None] * n, pairs[held]], pa.list_(pa.int64())),
                    pa.array([*[None] * n, times[held]], pa.list_(pa.int64())),
                ]
                del sizes, links, begins, pairs, own  # the arrays grow again
                yield pa.RecordBatch.from_arrays(columns, ["block", "doc_id", *_COUNTS, "groups_sha256", "links", "pairs", "times"])
                at += n
                block += 1

    schema = f"block long, doc_id {kind.simpleString()}, {', '.join(f'{c} long' for c in _COUNTS)}, groups_sha256 string, links array<int>, pairs array<long>, times array<long>"
    return stored(docs.select("doc_id", "text").mapInArrow(align, schema))


def rated_pairs(blocks: DataFrame) -> DataFrame:
    """pair, total, best: links of each id pair over all blocks, and whether no other pair of its B id has more."""
    listed = blocks.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    totals = listed.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("total"))
    most = F.max("total").over(Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF)))  # no larger than A's vocabulary
    return totals.select("pair", "total", (F.col("total") == most).alias("best"))


def align(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row."""
    blocks = blocks_of(docs, a, b)
    listed = blocks.where("pairs is not null").select("block", F.posexplode("pairs").alias("k", "pair"))
    lists = listed.join(rated_pairs(blocks), "pair").groupBy("block").agg(F.collect_list(F.struct("k", "total", "best")).alias("rated"))
    lists = lists.select(F.col("block").alias("of"), "rated.k", "rated.total", "rated.best")
    rows = blocks.where("pairs is null").select("block", "doc_id", *_COUNTS, "groups_sha256", "links")

    def add(own: pa.Table, rated: pa.Table) -> pa.Table:
        values = {c: np.zeros(0, np.int64) for c in ("best", "total")}
        if rated.num_rows:
            order = np.argsort(rated.column("k").combine_chunks().flatten().to_numpy())
            values = {c: rated.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)[order] for c in values}
        links = own.column("links").combine_chunks()
        places, ends = links.flatten().to_numpy(), np.cumsum([0, *links.value_lengths().to_pylist()])
        sums = {}
        for c, of in values.items():
            upto = np.concatenate([[0], np.cumsum(of[places])])
            sums[c] = pa.array(upto[ends[1:]] - upto[ends[:-1]])
        made = {c: own.column(c) for c in ["doc_id", *_COUNTS]}
        return pa.table(made | {"n_best": sums["best"], "count_sum": sums["total"], "groups_sha256": own.column("groups_sha256")})

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {', '.join(f'{c} long' for c in [*_COUNTS, 'n_best', 'count_sum'])}, groups_sha256 string"
    return rows.groupBy("block").cogroup(lists.groupBy("of")).applyInArrow(add, schema)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
