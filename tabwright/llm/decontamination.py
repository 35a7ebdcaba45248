"""Benchmark decontamination by template canonicalisation.

A text becomes a template: numbers, quantities, units after numbers and names (capitals inside a sentence) turn
into typed placeholders, other words lose case and outer marks. Neighbouring numbers, neighbouring names, and a number and
its unit are one placeholder, so that values of more or fewer words keep their place. A capital that begins a sentence has
two readings, a plain word and a name (a name if names follow it), and so has a word in capitals that stands alone;
windows over such are hashed in both, all of a window's alike. Windows of ``WINDOW`` template words of all
documents are hash-joined with those of the benchmark. Hits of a document and an item line up on diagonals
(word place less item place); a diagonal is a leak if

* its hits cover ``coverage`` of the item's windows, or a run of at least ``run_words`` words in a row,
* counting only windows whose slots are consistent: a value in an item's slots stands for itself where it does so
  anywhere, else for the value that it stands for in more than half of its slots; slots with another value, and
  all slots of a value without such a meaning, take the windows over them out. Names have to be told apart in the
  document too; two numbers may be equal there. A run also counts if it is
  consistent for itself. Equal values make a ``verbatim`` leak, others a ``reparameterised`` one.

Where no diagonal is one, diagonals at most ``gap`` words apart are chained, for words put in or left out: the windows over
the places where the chain changes its diagonal aren't expected, and its windows have to cover ``coverage`` of the item's
words too.

The benchmark's windows are broadcast as sorted arrays in slices of at most ``slice_windows`` windows (16 bytes
each), so what a task holds is bounded whatever the benchmark's size; each slice reads the documents once.

Defined results: null and empty texts leak nothing; items of fewer than ``WINDOW`` words are one window as long as
they are and have to be met whole; items without words can't leak; repeated rows and repeated item ids give
rows of their own. Empty tables give empty results. Only the columns named are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.words import WordTable, window_hashes

WINDOW = 5
EDGES = ".,;:!?\"'()[]{}<>|*#$%&-_=+/\\«»„“”’‘¿¡…"
#: Units that become placeholders after a number, and words for numbers.
UNITS = frozenset("mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years percent dollar dollars cent cents euro euros degree degrees mph kph kmh hz khz mhz ghz w kw v a j kj cal kcal mb gb tb kb".split())
NUMBERS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())
_NUMBER = re.compile(r"[+\-−]?[$€£]?\d[\d.,:/]*%?(?:st|nd|rd|th)?$")
_QUANTITY = re.compile(r"[+\-−]?\d[\d.,]*([a-z°]+)$")
LITERAL, NUMBER, QUANTITY, UNIT, CAPITAL, SHOUT = range(6)
ENDS = 8  # added to a fact: the token ends a sentence
_SLOTS = {NUMBER: "<number>", QUANTITY: "<quantity>", UNIT: "<unit>", CAPITAL: "<name>"}
_RESULT = "doc_id long, text_crc long, item_id long, kind string, n_windows int, coverage double, run_words int, start_word int, end_word int"
_FIELDS = pa.schema([("doc_id", pa.int64()), ("text_crc", pa.int64()), ("item_id", pa.int64()), ("kind", pa.string()), ("n_windows", pa.int32()), ("coverage", pa.float64()), ("run_words", pa.int32()), ("start_word", pa.int32()), ("end_word", pa.int32())])


def describe(token: str) -> tuple[str, int]:
    """A token's bare word and its facts: what it may be, and whether a sentence ends with it."""
    bare = token.strip(EDGES) or token
    low = bare.lower()
    ends = ENDS if token.rstrip("\"')]»”’")[-1:] in ".!?:…|" else 0
    if _NUMBER.match(low) or low in NUMBERS:
        return low, NUMBER + ends
    quantity = _QUANTITY.match(low)
    if quantity and quantity[1] in UNITS:
        return low, QUANTITY + ends
    if low in UNITS:
        return low, UNIT + ends
    if bare.isupper() and len(bare) > 1:
        return low, SHOUT + ends
    return low, (CAPITAL if bare[:1].isupper() and not bare.isupper() else LITERAL) + ends


def slot_hash(kind: int) -> np.uint64:
    import xxhash

    return np.uint64(xxhash.xxh64_intdigest(_SLOTS[kind]))


_POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(255, 0x9E3779B97F4A7C15, np.uint64)]))


def template(hashes: np.ndarray, facts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes and facts -> of each template word: its hash, its hash where capitals that begin a sentence are names,
    its kind, its value and its first word's place. starts: where lines (and so sentences) begin."""
    kinds = facts & 7
    fresh = np.zeros(len(facts), bool)
    fresh[1:] = facts[:-1] >= ENDS
    fresh[starts[starts < len(facts)]] = True
    shout = kinds == SHOUT
    alone = shout.copy()
    alone[1:] &= ~shout[:-1]
    alone[:-1] &= ~shout[1:]
    kinds = np.where(shout, np.where(alone, CAPITAL, LITERAL), kinds)
    after_number = np.zeros(len(facts), bool)
    after_number[1:] = (kinds[:-1] == NUMBER) & ~fresh[1:]
    kinds = np.where((kinds == UNIT) & ~after_number, LITERAL, kinds)
    folded = np.zeros(len(facts), bool)
    folded[1:] = ~fresh[1:] & (kinds[1:] == kinds[:-1]) & ((kinds[1:] == NUMBER) | ((kinds[1:] == CAPITAL) & ~alone[1:] & ~alone[:-1]))
    folded |= kinds == UNIT
    at = np.flatnonzero(~folded)
    if not len(at):
        none = np.zeros(0, np.uint64)
        return none, none, kinds[at], none, at
    sizes = np.diff(np.append(at, len(facts)))
    last = at + sizes - 1
    values = hashes[at].copy()
    many = np.flatnonzero(sizes > 1)
    if len(many):
        unit = np.repeat(np.arange(len(many)), sizes[many])
        inner = np.arange(len(unit)) - np.repeat(np.cumsum(sizes[many]) - sizes[many], sizes[many])
        with np.errstate(over="ignore"):
            values[many] = np.add.reduceat(hashes[at[many][unit] + inner] * _POWERS[inner & 255], np.flatnonzero(inner == 0))
    own = np.where(kinds[last] == UNIT, QUANTITY, kinds[at])
    named = values.copy()
    for kind in _SLOTS:
        named[own == kind] = slot_hash(kind)
    out = named.copy()
    first = np.flatnonzero((own == CAPITAL) & (fresh[at] | alone[at]))
    with np.errstate(over="ignore"):
        out[first] = hashes[at[first]] + np.where(sizes[first] > 1, slot_hash(CAPITAL), np.uint64(0))
    return out, named, own, values, at


def both_readings(out: np.ndarray, named: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes and places: of all windows, then of those that the other reading changes."""
    windows = window_hashes(out, size)
    differs = np.concatenate([[0], np.cumsum(out != named)])
    other = np.flatnonzero(differs[size:] != differs[: max(0, len(differs) - size)])
    if not len(other):
        return windows, np.arange(len(windows))
    return np.concatenate([windows, window_hashes(named, size)[other]]), np.concatenate([np.arange(len(windows)), other])


def read_text(text: str) -> tuple[list[str], list[int]]:
    """Words, and the places of those that begin a line."""
    words: list[str] = []
    starts: list[int] = []
    for line in text.split("\n"):
        starts.append(len(words))
        words += line.split()
    return words, starts


class Index:
    """A slice of the benchmark: sorted window hashes with their items and places."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        table = WordTable(describe)
        self.ids, self.words, self.kinds, self.counts, self.sizes, self.starts = [], [], [], [], [], []
        hashes, owners, places = [], [], []
        for item_id, text in items:
            words, starts = read_text(text or "")
            if not words:
                continue
            raw, facts = table.read(words)
            made, named, kinds, values, first = template(raw, facts, np.array(starts))
            size = min(WINDOW, len(made))
            found, at = both_readings(made, named, size)
            hashes.append(found)
            owners.append(np.full(len(found), len(self.ids)))
            places.append(at)
            self.ids.append(item_id)
            self.words.append(values)
            self.starts.append(np.append(first, len(words)))
            self.kinds.append(kinds)
            self.counts.append(len(made) - size + 1)
            self.sizes.append(size)
        every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.hashes = every[order]
        self.owners = np.concatenate(owners)[order].astype(np.int32) if hashes else np.zeros(0, np.int32)
        self.places = np.concatenate(places)[order].astype(np.int32) if hashes else np.zeros(0, np.int32)
        self.lengths = sorted(set(self.sizes))
        # A fixed 2 MB map of hash beginnings lets almost all windows pass by without a search.
        self.bits = np.zeros(1 << 21, bool)
        self.bits[(self.hashes >> np.uint64(43)).astype(np.int64)] = True

    def hits(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the windows and rows of the index that match."""
        at = np.flatnonzero(self.bits[(windows >> np.uint64(43)).astype(np.int64)])
        low = np.searchsorted(self.hashes, windows[at], "left")
        high = np.searchsorted(self.hashes, windows[at], "right")
        times = high - low
        rows = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(at, times), rows


def _unlike(mine: list[int], theirs: list[int]) -> list[bool]:
    """Of slots with these values, whether a slot's other value isn't what its value stands for."""
    meant: dict[int, dict[int, int]] = {}
    for a, b in zip(mine, theirs, strict=True):
        seen = meant.setdefault(a, {})
        seen[b] = seen.get(b, 0) + 1
    meaning = {}
    for a, seen in meant.items():
        best = a if a in seen else max(seen, key=seen.get)
        meaning[a] = best if best == a or 2 * seen[best] > sum(seen.values()) else None
    return [meaning[a] != b for a, b in zip(mine, theirs, strict=True)]


def _consistent(places: np.ndarray, length: int, slot: np.ndarray, name: np.ndarray, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Those of the windows (their places in the item) that lie over no inconsistent slot. slot, name, mine, theirs: of each of
    the item's words, whether it is a slot, a name, its value, and the document's value on the diagonal."""
    covered = np.zeros(len(mine), bool)
    for k in range(length):
        covered[places + k] = True
    bad = np.zeros(len(mine) + 1, np.int64)
    at = np.flatnonzero(covered & slot)
    bad[at + 1] = _unlike(mine[at].tolist(), theirs[at].tolist())
    at = np.flatnonzero(covered & name)
    bad[at + 1] |= np.array(_unlike(theirs[at].tolist(), mine[at].tolist()), np.int64)
    before = np.cumsum(bad)
    return places[before[places + length] == before[places]]


def _longest(places: np.ndarray, length: int, word: np.ndarray) -> int:
    """Words that the longest run of windows at consecutive places covers. word: words before each of the item's places."""
    if not len(places):
        return 0
    ends = np.append(np.flatnonzero(np.diff(places) != 1), len(places) - 1)
    return int((word[places[ends] + length] - word[places[np.append(0, ends[:-1] + 1)]]).max())


def _leaks(index: Index, coverage: float, run_words: int, gap: int = 3):
    def group_leaks(doc_ids: list, texts: list[str], table: WordTable) -> Iterator[tuple]:
        words: list[str] = []
        starts: list[int] = []
        bounds = [0]
        for text in texts:
            own, lines = read_text(text)
            starts += [bounds[-1] + s for s in lines]
            words += own
            bounds.append(len(words))
        raw, facts = table.read(words)
        made, named, kinds, raw, word = template(raw, facts, np.array(starts))
        word = np.append(word, len(words))
        edges = np.searchsorted(word, np.array(bounds))
        for length in index.lengths:
            windows, window_at = both_readings(made, named, length)
            at, rows = index.hits(windows)
            at = window_at[at]
            owner, place = index.owners[rows], index.places[rows]
            doc = np.searchsorted(edges, at, "right") - 1
            ok = (at + length <= edges[doc + 1]) & (np.array(index.sizes)[owner] == length) if len(at) else np.zeros(0, bool)
            at, owner, place, doc = at[ok], owner[ok], place[ok].astype(np.int64), doc[ok]
            if not len(at):
                continue
            diagonal = at - place
            order = np.lexsort((at, diagonal, owner, doc))
            at, owner, place, doc, diagonal = at[order], owner[order], place[order], doc[order], diagonal[order]
            # A window that both readings find counts once.
            once = np.ones(len(at), bool)
            once[1:] = (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1]) | (diagonal[1:] != diagonal[:-1]) | (at[1:] != at[:-1])
            at, owner, place, doc, diagonal = at[once], owner[once], place[once], doc[once], diagonal[once]
            new = np.ones(len(at), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1]) | (diagonal[1:] != diagonal[:-1])
            broken = new.copy()
            broken[1:] |= at[1:] != at[:-1] + 1
            run_starts = np.flatnonzero(broken)
            run_sizes = np.diff(np.append(run_starts, len(at)))
            first = np.flatnonzero(new)
            group_of_run = np.searchsorted(first, run_starts, "right") - 1
            longest = np.zeros(len(first), np.int64)
            run_ends = run_starts + run_sizes - 1
            np.maximum.at(longest, group_of_run, word[at[run_ends] + length] - word[at[run_starts]])
            counts = np.diff(np.append(first, len(at)))
            share = counts / np.array(index.counts)[owner[first]]
            best: dict[tuple[int, int], tuple] = {}
            for g in np.flatnonzero((share >= coverage) | (longest >= run_words)):
                low, high = first[g], first[g] + counts[g]
                d, item = int(doc[low]), int(owner[low])
                mine, shift = index.words[item], int(diagonal[low])
                span = np.clip(np.arange(len(mine)) + shift, 0, len(raw) - 1)
                theirs = raw[span]
                slot = (index.kinds[item] != LITERAL) | (kinds[span] != LITERAL)
                # A run has as many words as it has in both texts: a long list of numbers is one placeholder.
                steps = np.minimum(np.diff(index.starts[item]), np.diff(word)[span])
                before = np.append(0, np.cumsum(steps))
                every = place[low:high]
                name = (index.kinds[item] == CAPITAL) & (kinds[span] == CAPITAL)
                left = _consistent(every, length, slot, name, mine, theirs)
                if len(left) / index.counts[item] < coverage and _longest(left, length, before) < run_words:
                    # What clashes with a run may lie elsewhere on the diagonal.
                    runs = [r for r in np.split(every, np.flatnonzero(np.diff(every) != 1) + 1) if _longest(r, length, before) >= run_words]
                    left = max((_consistent(r, length, slot, name, mine, theirs) for r in runs), key=lambda r: _longest(r, length, before), default=every[:0])
                    if _longest(left, length, before) < run_words:
                        continue
                inside = np.unique(left[:, None] + np.arange(length))
                kind = "verbatim" if (mine[inside] == theirs[inside]).all() else "reparameterised"
                start, end = (int(word[at] - bounds[d]) for at in (left[0] + shift, left[-1] + shift + length))
                found = (len(left), len(left) / index.counts[item], _longest(left, length, before), start, end, kind)
                if (d, item) not in best or (found[0], -found[3]) > (best[d, item][0], -best[d, item][3]):
                    best[d, item] = found
            # Chains of neighbouring diagonals.
            apart = new.copy()
            apart[1:] = (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1]) | (diagonal[1:] - diagonal[:-1] > gap)
            chains = np.flatnonzero(apart)
            chain_hits = np.diff(np.append(chains, len(at)))
            bends = np.add.reduceat(new, chains, dtype=np.int64) - 1
            expected = np.maximum(np.array(index.counts)[owner[chains]] - (length - 1 + gap) * bends, 1)
            for c in np.flatnonzero((bends > 0) & (chain_hits >= coverage * expected)):
                low, high = chains[c], chains[c] + chain_hits[c]
                d, item = int(doc[low]), int(owner[low])
                if (d, item) in best:
                    continue
                mine = index.words[item]
                # Each of the item's windows once, at places of the document that go on.
                order = np.lexsort((at[low:high], place[low:high])) + low
                every, shifts, reached = [], [], -1
                for h in order.tolist():
                    if at[h] > reached and (not every or place[h] > every[-1]):
                        every.append(int(place[h]))
                        shifts.append(int(diagonal[h]))
                        reached = int(at[h])
                every, shifts = np.array(every), np.array(shifts)
                shift_of = np.zeros(len(mine), np.int64)
                inside = np.zeros(len(mine), bool)
                for k in range(length - 1, -1, -1):
                    shift_of[every + k] = shifts
                    inside[every + k] = True
                span = np.clip(np.arange(len(mine)) + shift_of, 0, len(raw) - 1)
                theirs = raw[span]
                slot = inside & ((index.kinds[item] != LITERAL) | (kinds[span] != LITERAL))
                name = inside & (index.kinds[item] == CAPITAL) & (kinds[span] == CAPITAL)
                left = _consistent(every, length, slot, name, mine, theirs)
                bend = np.diff(shifts)
                bend = bend[bend != 0]  # words put in, or left out if less than none
                wanted = max(1, index.counts[item] - (length - 1) * len(bend) - int(np.maximum(-bend, 0).sum()))
                covered = np.unique(left[:, None] + np.arange(length))
                if len(left) < coverage * wanted or len(covered) < coverage * len(mine):
                    continue
                steps = np.append(0, np.cumsum(np.minimum(np.diff(index.starts[item]), np.diff(word)[span])))
                kind = "verbatim" if (mine[covered] == theirs[covered]).all() else "reparameterised"
                start, end = int(word[left[0] + shift_of[left[0]]] - bounds[d]), int(word[left[-1] + length - 1 + shift_of[left[-1]] + 1] - bounds[d])
                best[d, item] = (len(left), min(1.0, len(left) / wanted), _longest(left, length, steps), start, end, kind)
            for (d, item), (n, cover, run, start, end, kind) in best.items():
                yield doc_ids[d], zlib.crc32(texts[d].encode()), index.ids[item], kind, n, cover, run, start, end

    return group_leaks


def find_leaks(documents: DataFrame, benchmark: DataFrame, coverage: float = 0.8, run_words: int = 13, gap: int = 3, slice_windows: int = 2_000_000) -> DataFrame:
    """documents(doc_id, text), benchmark(item_id, text) -> a row for each document and item that it leaks.

    ``text_crc`` (crc32 of the text) tells rows apart that share an id.
    """
    from tabwright.llm.encoding import text_groups

    spark = documents.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), "text")
    sized = items.select("*", F.size(F.split(F.coalesce("text", F.lit("")), r"\s+")).alias("size"))
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    slices = max(1, -(-total // slice_windows))
    found = None
    for k in range(slices):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k)
        index = spark.sparkContext.broadcast(Index(sorted(((r["item_id"], r["text"]) for r in part.toLocalIterator()), key=repr)))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            table = WordTable(describe)
            work = _leaks(index.value, coverage, run_words, gap)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                texts = [t or "" for t in batch.column(1).to_pylist()]
                rows = [row for low, high in text_groups(texts) for row in work(ids[low:high], texts[low:high], table)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FIELDS, strict=True)], schema=_FIELDS)

        leaks = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _RESULT)
        found = leaks if found is None else found.unionByName(leaks)
    return found
