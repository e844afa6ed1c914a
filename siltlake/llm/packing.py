"""Best-fit packing with a swap-based local search.

Documents become token pieces of at most CAPACITY tokens. Full pieces are sequences of their own.
The others are dealt at random into shards of bounded size; inside a shard, best fit decreasing
opens the bins, then a local search exchanges pieces between bins that are not full: one moves, or one or two
go for one, or one for two, whenever that makes the fuller bin fuller still and so raises the sum of squared
fills. Bins that run empty go. It ends where no exchange is left, or where the tokens need as many bins as
there are. Pieces of bins that are not full meet those of other shards in further rounds, until one shard
is left, a round empties no bin, or no fewer bins could hold them. Only lengths travel; token ids never do.

Defined results: a null text counts as empty and makes one piece holding the end token alone; special strings
of the tokenizer give their ids, as it gives them by default; every piece gets a number of its own
when pieces are first written, by which ties are broken and repeated rows (the same doc_id
twice) are told apart; an empty table gives no pieces; extra columns are ignored. Texts of any length are
encoded whole.
"""

from __future__ import annotations

import bisect
import codecs
import functools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm.common import arrays, cut, release, shape, table, texts

#: Name of the public vocabulary.
VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 1
#: Pieces a shard holds on average: the bound on what one task packs at once.
SHARD = 8_000
#: Characters of distinct chunks, and of parts of chunks, whose ids a worker remembers; longer ones than LONG are not remembered.
CHUNKS, PARTS, LONG = 3_000_000, 3_000_000, 200
#: Bytes of texts whose words a worker parts and numbers at once; a longer text is cut at white space.
GROUP = 4_000_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Token ids of whole texts, put together from those of their chunks between spaces, by the tokenizer as it comes.

    The tokenizer drops white space and never joins what stands on both sides of it, so the ids of
    a text are those of its chunks in a row; chunks that recur are encoded once. It also lower-cases,
    and parts letters from signs that follow them; so a new chunk is put together from its letters in
    lower case and the signs at its end, which recur more often than the chunk. A chunk that may hold a special
    string is left to the tokenizer as it is.

    encode() takes one text. encode_all() takes many: it finds their words by array operations over all bytes and looks
    each distinct one up once; texts that may hold a special string go through encode().
    """

    TAIL = ",.;:!?#$%&*|"
    #: A chunk with a character outside these is left to the tokenizer as it is.
    ODD = re.compile(r"[^\x00-įĲ-ſ]")

    def __init__(self, tokenizer: str | None = None, chunks: int | None = None, parts: int | None = None):
        self.most_chunks, self.most_parts = chunks or CHUNKS, parts or PARTS
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer or public_tokenizers.path(VOCABULARY))
        self.model = self.tokenizer.model
        # Byte-level vocabularies show a byte as its own character if it prints, else as one from 256 on.
        prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in prints]
        shown = {b: 256 + n for n, b in enumerate(hidden)}
        self.bytes_shown = "".join(chr(shown.get(b, b)) for b in range(256))
        # White space that parts words, signs of TAIL, letters and digits, other bytes.
        self.kinds = np.array([0 if b in b" \t\n\r" else 1 if b in self.TAIL.encode() else 2 if b < 128 and chr(b).isalnum() else 4 for b in range(256)], np.uint8)
        self.forget()
        self.space = re.compile(r"[\t\n\r]")

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}
        self.parts_before: dict[str, bytes] = {}
        self.held = self.held_parts = 0

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        # What is remembered lies in two halves: a full one becomes the older, and what is met again comes over from it.
        if 2 * self.held > self.most_chunks:
            self.known, self.known_before, self.held = {}, self.known, 0
        chunks = self.space.sub(" ", text).split(" ")
        found = list(map(self.known.get, chunks))
        try:
            return b"".join(found)
        except TypeError:  # some are new
            new = list(dict.fromkeys([c for c, ids in zip(chunks, found) if ids is None]))
        known, before = self.known, self.known_before
        again = [c for c in new if c in before]
        known.update((c, before[c]) for c in again)
        self.held += sum(map(len, again))
        self.learn([c for c in new if c not in known] if again else new)
        out = b"".join([known[c] if ids is None else ids for c, ids in zip(chunks, found)])
        for c in new:
            if len(c) > LONG:
                del known[c]
        return out

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """What encode() gives, for every text in turn; a null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes, special = pc.binary_length(texts).to_pylist(), pc.match_substring(texts, "<|").to_pylist()
        begin = held = 0
        for k, size in enumerate(sizes):
            if k > begin and (special[k] or held + size > GROUP):
                yield from self.encode_group(texts.slice(begin, k - begin))
                begin, held = k, 0
            if special[k]:
                yield self.encode(texts[k].as_py())
                begin = k + 1
            elif size > GROUP:
                yield b"".join(self.encode_group(pa.array([part]))[0] for part in parted(texts[k].as_py(), GROUP))
                begin = k + 1
            else:
                held += size
        if len(texts) > begin:
            yield from self.encode_group(texts.slice(begin))

    def words(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The words of texts without special strings, in a row, and the number of words before each text and after the last.

        White space parts words, and so do the edges between ASCII or Latin-1 letters or digits and signs of TAIL, which
        the tokenizer never joins. Letters of both kinds are lower-cased unless a mark may follow them and join them first.
        """
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
        at = at - at[0]
        kind = self.kinds[raw]
        alone = np.ones(len(raw), bool)  # no character beyond U+017F follows
        alone[:-1] = raw[1:] < 0xC6
        alone[at[1:][at[1:] > 0] - 1] = True
        low = raw + (((raw >= 65) & (raw <= 90) & alone).view(np.uint8) << 5)
        first = np.flatnonzero(raw[:-1] == 0xC3)
        second = raw[first + 1]
        letter = (second != 0x97) & (second != 0xB7)  # the signs of multiplication and division
        first, second = first[letter], second[letter]
        kind[first] = kind[first + 1] = 2
        low[first + 1] += ((second <= 0x9E) & alone[first + 1]).view(np.uint8) << 5
        before = np.zeros(len(raw), np.uint8)
        before[1:] = kind[:-1]
        before[at[:-1][at[:-1] < len(raw)]] = 0
        starts = (kind != 0) & ((before == 0) | (before + kind == 3))
        shown = kind != 0
        data, places = low[shown], np.append(np.flatnonzero(starts[shown]), np.count_nonzero(shown)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places), pa.py_buffer(data))
        return words.dictionary_encode(), np.searchsorted(np.flatnonzero(starts), at)

    def encode_group(self, texts: pa.Array) -> list[bytes]:
        words, bounds = self.words(texts)
        self.turn()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.parts.get, distinct))
        if new := [w for w, ids in zip(distinct, found) if ids is None]:
            self.learn_parts(new)
            found = [self.parts[w] if ids is None else ids for w, ids in zip(distinct, found)]
            for w in new:
                if len(w) > LONG:
                    del self.parts[w]
        ids, count = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin, word = np.cumsum(count) - count, words.indices.to_numpy()
        own = count[word]
        ends = np.concatenate([[0], np.cumsum(own)])
        flat = ids[np.repeat(begin[word] - ends[:-1], own) + np.arange(ends[-1])].tobytes()
        edges = (4 * ends[bounds]).tolist()
        return [flat[a:b] for a, b in zip(edges, edges[1:])]

    def turn(self) -> None:
        if 2 * self.held_parts > self.most_parts:
            self.parts, self.parts_before, self.held_parts = {"": b""}, self.parts, 0

    def learn_parts(self, new: list[str]) -> None:
        """Ids of distinct parts that are not known."""
        self.held_parts += sum(map(len, new))
        rest = []
        for p in new:
            ids = self.parts_before.get(p)
            if ids is None:
                # One run of letters is one word to the model, which then needs no normalising or splitting.
                if not p.isalpha() or not p.isascii() and self.ODD.search(p):
                    rest.append(p)
                    continue
                low = p.lower()
                seen = low if p.isascii() else codecs.charmap_decode(low.encode(), "strict", self.bytes_shown)[0]
                ids = [x.id for x in self.model.tokenize(seen)]
                ids = struct.pack(f"<{len(ids)}I", *ids)
            self.parts[p] = ids
        for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self.parts[p] = np.array(e.ids, "<u4").tobytes()

    def learn(self, chunks: list[str]) -> None:
        self.turn()
        pairs = []
        for c in chunks:
            if "<|" in c or self.ODD.search(c):
                pairs.append((c, ""))
                continue
            low = c.lower()
            head = low.rstrip(self.TAIL)
            pairs.append((head, low[len(head) :]) if head and head[-1].isalpha() else (low, ""))
        if new := [p for p in dict.fromkeys(p for pair in pairs for p in pair) if p not in self.parts]:
            self.learn_parts(new)
        for c, (head, tail) in zip(chunks, pairs):
            self.known[c] = self.parts[head] + self.parts[tail]
        self.held += sum(map(len, chunks))
        for head in {head for head, _ in pairs if len(head) > LONG}:
            del self.parts[head]


def parted(text: str, most: int) -> Iterator[str]:
    """A text cut before white space, into parts of at most so many characters where that allows it."""
    at = 0
    while at < len(text):
        end = at + most
        if end < len(text):
            last = max(text.rfind(c, at + 1, end + 1) for c in " \t\n\r")
            end = last if last > 0 else min((k for c in " \t\n\r" if (k := text.find(c, end)) > 0), default=len(text))
        yield text[at:end]
        at = end


@functools.lru_cache(maxsize=1)
def kept(tokenizer: str | None, chunks: int, parts: int) -> Encoder:
    """A worker's encoder, which outlives a task: the next one begins with what is remembered."""
    return Encoder(tokenizer, chunks, parts)


def cut_batches(tokenizer: str | None, capacity: int, with_ids: bool):
    columns = shape(PIECES.split(", ", 1)[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = kept(tokenizer, CHUNKS, PARTS), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            of, out, ids = [], [], []
            for i, text_ids in enumerate(encoder.encode_all(batch["text"])):
                whole = text_ids + end
                for piece, at in enumerate(range(0, len(whole), 4 * capacity)):
                    own = whole[at : at + 4 * capacity]
                    of.append(i)
                    out.append((piece, at // 4, len(own) // 4, zlib.crc32(own)))
                    if with_ids:
                        ids.append(np.frombuffer(own, "<u4").astype(np.int64))
            made = [batch["doc_id"].take(pa.array(of, pa.int32())), *arrays(out, columns)]
            names = ["doc_id", *columns.names]
            yield pa.RecordBatch.from_arrays(made + [pa.array(ids, pa.list_(pa.int64()))] * with_ids, names + ["ids"] * with_ids)
        release()

    return run


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece; with_ids adds the token ids themselves. tokenizer is a file's place, the public vocabulary's if not given."""
    return texts(docs).mapInArrow(cut_batches(tokenizer, capacity, with_ids), PIECES + ", ids array<long>" * with_ids)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best fit decreasing: bins as lists of places in lengths."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # free tokens and bin, sorted
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect.bisect_left(room, (lengths[i], -1))
        if at == len(room):
            bins.append([i])
            free, b = capacity - lengths[i], len(bins) - 1
        else:
            free, b = room.pop(at)
            bins[b].append(i)
            free -= lengths[i]
        if free:
            bisect.insort(room, (free, b))
    return bins


class Bins:
    """Bins of pieces with the pieces' sizes by bin in flat arrays, for the local search.

    Within a bin pieces of one size are alike, so at most some ninety sizes of a bin of 4096 tokens matter, however
    many pieces it holds.
    """

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.capacity, self.lengths = capacity, lengths
        self.held: list[dict[int, list[int]]] = []
        for b in bins:
            sizes: dict[int, list[int]] = {}
            for i in b:
                sizes.setdefault(lengths[i], []).append(i)
            self.held.append(sizes)
        self.fill = np.array([sum(lengths[i] for i in b) for b in bins], np.int64)
        self.one, self.two = [None] * len(bins), [None] * len(bins)
        for b in range(len(bins)):
            self.refresh(b)

    def refresh(self, b: int) -> None:
        """The sums that one piece, and that two pieces, of a bin make."""
        sizes = np.array(sorted(self.held[b]), np.int64)
        low, high = np.triu_indices(len(sizes), 1)
        twice = np.array([n for n in sizes.tolist() if len(self.held[b][n]) > 1], np.int64)
        self.one[b], self.two[b] = sizes, np.unique(np.concatenate([sizes[low] + sizes[high], 2 * twice]))

    def pair(self, b: int, total: int) -> list[int]:
        """Sizes of two pieces of a bin that make total."""
        for n in self.held[b]:
            if total - n in self.held[b] and (total != 2 * n or len(self.held[b][n]) > 1):
                return [n, total - n]
        raise KeyError(total)

    def swap(self, poor: int, rich: np.ndarray) -> tuple[int, list[int], list[int]] | None:
        """The exchange of a bin with fuller ones that has the largest gain: the other bin, the sizes that leave and those that come back."""
        best = (0, None)
        for out, back in (("one", "none"), ("one", "one"), ("two", "one"), ("one", "two")):
            leaving = getattr(self, out)[poor]
            if back == "none":
                coming, of = np.zeros(len(rich), np.int64), rich
            else:
                sizes = [getattr(self, back)[b] for b in rich.tolist()]
                coming, of = np.concatenate(sizes), np.repeat(rich, [len(s) for s in sizes])
            if not len(coming) or not len(leaving):
                continue
            # A gain fits if it is at most the bin's room: of the sums that leave, the largest up to what comes back and the room.
            most = coming + self.capacity - self.fill[of]
            at = np.searchsorted(leaving, most, side="right") - 1
            gain = np.where(at >= 0, leaving[np.maximum(at, 0)] - coming, 0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (int(gain[k]), (int(of[k]), out, int(leaving[at[k]]), back, int(coming[k])))
        if best[1] is None:
            return None
        b, out, leaves, back, comes = best[1]
        return b, [leaves] if out == "one" else self.pair(poor, leaves), [] if back == "none" else [comes] if back == "one" else self.pair(b, comes)

    def move(self, a: int, b: int, sizes: list[int]) -> None:
        for n in sizes:
            i = self.held[a][n].pop()
            if not self.held[a][n]:
                del self.held[a][n]
            self.held[b].setdefault(n, []).append(i)
            self.fill[a] -= n
            self.fill[b] += n


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Local search between the bins that are not full, to a local optimum.

    Takes bins from the emptiest on and exchanges with those at least as full that are not full yet, the largest
    gain first. Each exchange raises the sum of squared fills, so the search ends. Empty bins go. Where the
    tokens need as many bins as there are, nothing is to be gained.
    """
    if len(bins) <= -(-sum(lengths[i] for b in bins for i in b) // capacity):
        return bins
    full = [b for b in bins if sum(lengths[i] for i in b) == capacity]
    b = Bins([b for b in bins if sum(lengths[i] for i in b) < capacity], lengths, capacity)
    least = -(-int(b.fill.sum()) // capacity)
    live = [k for k in range(len(b.held)) if b.fill[k]]
    changed = True
    while changed and len(live) > least:
        changed = False
        for poor in sorted(live, key=lambda k: b.fill[k]):
            while b.fill[poor] and len(live) > least:
                rich = np.array([k for k in live if k != poor and b.fill[poor] <= b.fill[k] < capacity], np.int64)
                found = b.swap(poor, rich) if len(rich) else None
                if not found:
                    break
                other, out, back = found
                b.move(poor, other, out)
                b.move(other, poor, back)
                b.refresh(poor)
                b.refresh(other)
                changed = True
                if not b.fill[poor]:
                    live.remove(poor)
    return full + [[i for places in b.held[k].values() for i in places] for k in live]


def pack_shard(capacity: int, last: bool):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("copy")
        lengths = rows["length"].to_pylist()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        packed = np.zeros(len(lengths), bool)
        for n, b in enumerate(improve(best_fit(lengths, capacity), lengths, capacity)):
            at = 0
            for i in b:
                sequence[i], offset[i] = n, at
                at += lengths[i]
            packed[b] = last or at == capacity
        made = {"bin": sequence, "offset": offset, "packed": packed}
        return pa.table({n: rows[n] for n in rows.column_names} | made).select(PACKED.names)

    return run


PLACED = PIECES + ", copy long, shard long, bin long, offset long, packed boolean"
PACKED = shape(PLACED)


def pack(found: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Adds sequence_id and offset to rows of pieces().

    A sequence's number holds the round, the shard and the bin within it.
    """
    # A number of its own for every row, so that rows that are alike get places of their own too.
    keyed = cut(found.withColumn("copy", F.monotonically_increasing_id()))
    is_full = F.col("length") >= capacity
    full = keyed.where(is_full).withColumn("sequence_id", -1 - F.col("copy")).withColumn("offset", F.lit(0).cast("long"))
    out = [full.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")]
    rest = keyed.where(~is_full)
    n_open, turn, bins_before = rest.count(), 0, None
    while n_open:
        shards = max(1, round(n_open / shard))
        dealt = rest.withColumn("shard", F.pmod(F.xxhash64("copy", F.lit(turn)), F.lit(shards)))
        done = cut(dealt.groupBy("shard").applyInArrow(pack_shard(capacity, shards == 1), PLACED))
        number = F.lit(turn) * (1 << 50) + F.col("shard") * (1 << 20) + F.col("bin")
        left = done.where("NOT packed")
        bins = left.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("tokens"))
        n_open, n_bins, tokens = bins.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
        ends = n_bins <= -(-tokens // capacity) or (bins_before is not None and n_bins >= bins_before)
        out.append((done if ends else done.where("packed")).withColumn("sequence_id", number).select(*out[0].columns))
        if ends:
            break
        rest, turn, bins_before = left.select(*keyed.columns), turn + 1, n_bins
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents")))
