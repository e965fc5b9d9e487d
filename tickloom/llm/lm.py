"""Language-model scores by logistic context mixing over the bits of words.

A text is a sequence of words and an end. Each word is coded bit by bit: several
predictors look up, by a hash of their context, how often the next bit was 0 or 1 in
training. Contexts are the last one, two, three, four and six bytes and the word
so far, in part with the state of the text. The predictions meet in the logistic
domain, each under a weight gated by how much its context has seen and by the bit's
place; the mix is then refined by an adaptive table of what such mixes were worth. The
state is the class of the last short word, which tells languages and styles apart.

Tables have a fixed size, and contexts share their slots by hash: those of all words are
counted, however rare. The two predictors of whole words can be held to marked words
instead, which they follow for as long as a word agrees with one; scoring marks none.

Statistics are frozen before scoring. A word's cost depends on itself and the state
alone, so it is worked out once per distinct pair and summed over the texts. Pairs are
kept in the order of their words, and what a word has in common with the one before it is
worked out once for both, as is for all states what does not depend on them: see
:func:`branches` and :class:`Nodes`.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.ragged import U64, Hasher, flat, gather, mix, pieces, strings, words
from tickloom.llm.store import written

STATES = 16
#: Words up to this many bytes set the state.
STATE_WORD_BYTES = 3
#: The end of a text, as a word; no word of a text holds a line feed.
END = "\n"
#: Slots of each predictor's table, as a power of two.
SLOT_BITS = (20, 20, 20, 21, 21, 21, 21)
#: The predictors of whole words: of the word alone, and with the state.
WORD, STATE_WORD = 5, 6
N_PREDICTORS = len(SLOT_BITS)
#: The predictors whose context has the state in it.
STATEFUL = (1, 3, STATE_WORD)
STATELESS = tuple(i for i in range(N_PREDICTORS) if i not in STATEFUL)
#: Pairs that are searched for shared bytes at once.
ROWS_AT_ONCE = 1 << 14
#: Bytes and states whose bits are worked on at once.
NODES_AT_ONCE = 12288
#: The tables are put together in blocks of this many slots.
BLOCK_BITS = 14
CONFIDENCES = 24
REFINED = 33
#: Passes over all pairs of state and word in which the mixing weights are learned.
PASSES = 4
#: The first passes work out how the loss curves; the others go by the last of these.
CURVED_PASSES = 2
#: How strongly weights are held to even ones, in tokens.
PRIOR = 10.0
#: Sums of a pass are added up in so many parts.
SUM_PARTS = 16
#: A word with at least this share of all tokens is frequent, so there are no more than
#: its inverse (in texts, with their few common words, a tenth of that).
FREQUENT_SHARE = 2.0**-20
#: A task adds up pairs of state and word over so many, or so many bytes of them.
HELD_PAIRS, HELD_BYTES = 1 << 19, 1 << 24
#: A task hands on its counts before they can exceed 32 bits.
MOST_COUNTED = 1 << 31
LOG10_2 = float(np.log10(2.0))


def _spelled(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words followed by a blank each; the blank ends the word and is coded too."""
    lengths = np.diff(offsets)
    out = np.full(len(data) + len(lengths), 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(len(lengths)), lengths)] = data
    return out, offsets + np.arange(len(offsets))


def branches(data: np.ndarray, offsets: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words part from the one before, and for every byte where to find its like.

    Contexts reach back to the start of a word and its state only, so the bits of a prefix
    that a word shares with the one before it under the same state have the same slots.
    Returns the positions of all other bytes, and per byte the number among these of the
    one that stands for it. In sorted words that is a third of the bytes or less.
    """
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(data)) - offsets[row]
    before = np.maximum(row - 1, 0)
    alike = (row > 0) & (inside < lengths[before]) & (states[before] == states[row])
    alike &= data[np.minimum(offsets[before] + inside, len(data) - 1)] == data
    parted = np.concatenate((np.zeros(1, np.int64), np.cumsum(~alike)))
    fresh = parted[1:] > parted[offsets[row]]
    # By place in the word, then by word: a shared byte follows the one that it is like.
    order = np.argsort(inside.astype(np.uint16) if lengths.max(initial=0) < 1 << 16 else inside, kind="stable")
    stands = np.maximum.accumulate(np.where(fresh[order], np.arange(len(data)), 0))
    owner = np.empty(len(data), np.int64)
    owner[order] = (np.cumsum(fresh) - 1)[order[stands]]
    return np.flatnonzero(fresh), owner


def _contexts(data: np.ndarray, offsets: np.ndarray, only: np.ndarray) -> list[np.ndarray]:
    """Per predictor what some bytes of spelled words are predicted from, but for the state."""
    lengths = np.diff(offsets)
    inside = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
    wide = data.astype(U64) + U64(1)
    hasher_up = mix(wide + (inside.astype(U64) << U64(9)))
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(hasher_up, dtype=U64)))
    inside = inside[only]
    prefix = mix(sums[only] - sums[only - inside] + inside.astype(U64))
    back = [np.where(inside > k, wide.take(only - (k + 1), mode="wrap"), U64(0)) for k in range(6)]
    two = back[0] | back[1] << U64(9)
    three = two | back[2] << U64(18)
    four = three | back[3] << U64(27)
    six = (four | back[4] << U64(36) | back[5] << U64(45)) ^ U64(0x5A << 56)
    return [back[0], two, three + U64(2 << 40), four, six, prefix, prefix]


def _of_states(states: np.ndarray) -> np.ndarray:
    """What states add to the contexts of the predictors that go by them."""
    return mix(states.astype(U64) + U64(77))


_GOLDEN = U64(0x9E3779B97F4A7C15)
#: By what is known of the byte, what that adds to a mixed context times the golden ratio.
_SPREAD = mix(np.arange(256, dtype=U64) + U64(999)) * _GOLDEN
_PLACES = np.arange(8, dtype=U64)


def _entries(contexts: np.ndarray, spread: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Twice the slot and the bit, for all bits (bytes x 8); a slot serves bits of one place only.

    ``spread`` has what is known of the byte before each bit, ``ends`` twice the place and the bit.
    """
    found = (mix(contexts) * _GOLDEN)[:, None] + spread
    found >>= U64(64 - size - 1)
    found &= ~U64(15)
    found |= ends
    return found.view(np.int64)


def _bits_of(data: np.ndarray) -> np.ndarray:
    return ((data[:, None] >> np.arange(7, -1, -1, dtype=np.uint8)) & 1).astype(np.uint8)


def slots(data: np.ndarray, offsets: np.ndarray, states: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Per predictor the slots of all bits (bytes x 8) of spelled words, and the bits."""
    bits, spread = _bits_of(data), _SPREAD[nodes_of(data)]
    state = _of_states(np.repeat(states, np.diff(offsets)))
    contexts = _contexts(data, offsets, np.arange(len(data)))
    for i in STATEFUL:
        contexts[i] = contexts[i] ^ state
    return [_entries(c, spread, _PLACES * U64(2), size) >> 1 for c, size in zip(contexts, SLOT_BITS)], bits


class Nodes:
    """The bits of some words, each looked up once: bytes where words part, by state.

    Words that begin alike share bytes (:func:`branches`), whatever the states they follow,
    and predictors that leave the state out are looked up per such byte. The others are
    looked up per byte and state, for the states that any word through that byte follows.
    ``which`` has for each row its word, ``n`` its count.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, which: np.ndarray, states: np.ndarray, n: np.ndarray):
        self.offsets, self.which, self.states = offsets, which, states
        self.fresh, self.owner = branches(data, offsets, np.zeros(len(offsets) - 1, np.int64))
        # The words through a byte follow each other.
        self.first = (np.searchsorted(offsets, self.fresh, side="right") - 1).astype(np.int64)
        self.last = self.first + np.bincount(self.owner, minlength=len(self.fresh))
        tallies = self.tallied(n)
        at = np.flatnonzero(tallies)
        self.node, self.state, self.heavy = at // STATES, at % STATES, tallies.ravel().take(at)
        self.contexts = _contexts(data, offsets, self.fresh)
        data = data[self.fresh]
        self.bits, self.known = _bits_of(data), nodes_of(data)
        self.spread, self.ends = _SPREAD[self.known], _PLACES * U64(2) + self.bits

    def tallied(self, n: np.ndarray) -> np.ndarray:
        """For each byte and state, the counts ``n`` of the rows whose words go through it."""
        size = (len(self.offsets) - 1) * STATES
        totals = np.zeros((len(self.offsets), STATES))
        np.cumsum(np.bincount(self.which * STATES + self.states, n, size).reshape(-1, STATES), axis=0, out=totals[1:])
        return totals[self.last] - totals[self.first]

    def entries(self, i: int, nodes: slice = slice(None), pairs: slice = slice(None)) -> np.ndarray:
        """Twice the slot and the bit of predictor ``i``: by byte, or by byte and state."""
        if i not in STATEFUL:
            return _entries(self.contexts[i][nodes], self.spread[nodes], self.ends[nodes], SLOT_BITS[i])
        node = self.node[pairs]
        contexts = self.contexts[i].take(node) ^ _STATE_CONTEXTS.take(self.state[pairs])
        return _entries(contexts, self.spread.take(node, axis=0), self.ends.take(node, axis=0), SLOT_BITS[i])

    def followed(self, mark: np.ndarray, i: int) -> np.ndarray:
        """For each entry, whether its word has met only marked slots so far."""
        met = mark.take(self.entries(i) >> 1)
        whole = np.ones((len(self.fresh), STATES), bool)
        if i in STATEFUL:
            whole[self.node, self.state] = met.all(axis=1)
        else:
            whole[:] = met.all(axis=1)[:, None]
        strayed = np.zeros((len(self.owner) + 1, STATES), np.int64)
        np.cumsum(~whole[self.owner], axis=0, out=strayed[1:])
        clear = strayed[self.fresh] == strayed[self.offsets[self.first]]
        clear = clear[self.node, self.state] if i in STATEFUL else clear[:, 0]
        return clear[:, None] & np.logical_and.accumulate(met, axis=1)

    def parts(self) -> Iterator[tuple[slice, slice]]:
        """Some bytes at a time, and their pairs of byte and state."""
        begins = np.searchsorted(self.node, np.arange(len(self.fresh) + 1))
        cuts = np.searchsorted(begins, np.arange(0, len(self.node), NODES_AT_ONCE))
        cuts = np.unique(np.append(cuts, len(self.fresh)))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield slice(lo, hi), slice(begins[lo], begins[hi])


_STATE_CONTEXTS = _of_states(np.arange(STATES))


def nodes_of(data: np.ndarray) -> np.ndarray:
    """For each bit of each byte what is known of the byte, after a leading one."""
    shifts = np.arange(8, dtype=np.uint8)
    return (1 << shifts.astype(np.int64)) | (data[:, None] >> (8 - shifts)).astype(np.int64)


def _together(batches: Iterator[pa.RecordBatch], rows: int = 4000, n_bytes: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches as one, up to some thousand rows or some kB."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows or sum(b.nbytes for b in held) >= n_bytes:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _pair_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in pieces(_together(batches), "word", 1 << 16):
        data, offsets = _spelled(*flat(batch.column("word")))
        yield batch, data, offsets, batch.column("state").to_numpy(zero_copy_only=False)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Nodes, np.ndarray]]:
    """The bits of all pairs, piece by piece, and the counts of the pairs."""
    for batch in pieces(_together(batches, ROWS_AT_ONCE, 32 * ROWS_AT_ONCE), "word", 16 * ROWS_AT_ONCE, ROWS_AT_ONCE):
        column, n = batch.column("word"), batch.column("n").to_numpy()
        new = np.ones(len(column), bool)
        new[1:] = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        spelled = _spelled(*flat(column.filter(pa.array(new))))
        yield Nodes(*spelled, np.cumsum(new) - 1, batch.column("state").to_numpy(zero_copy_only=False), n), n


def marked(words_: list[str], pairs: list[tuple[int, str]]) -> dict[int, np.ndarray]:
    """Slots that whole-word predictors are held to: those of some words, and after states."""
    states = np.array([state for state, _ in pairs], np.int64)
    return _marked(pa.array(words_, pa.string()), states, pa.array([word for _, word in pairs], pa.string()))


def _marked(words_: pa.Array, states: np.ndarray, after: pa.Array) -> dict[int, np.ndarray]:
    """The same from columns: words; states and the words after them."""
    marks = {WORD: np.zeros(1 << SLOT_BITS[WORD], bool), STATE_WORD: np.zeros(1 << SLOT_BITS[STATE_WORD], bool)}
    for predictor, column, own in ((WORD, words_, np.zeros(len(words_), np.int64)), (STATE_WORD, after, states)):
        for lo in range(0, len(column), 4096):
            found, _ = slots(*_spelled(*flat(column.slice(lo, 4096))), own[lo : lo + 4096])
            marks[predictor][found[predictor].ravel()] = True
    return marks


def _packed(counts: np.ndarray) -> bytes:
    """Counts as planes of bytes, most of which are all zero, compressed."""
    return zlib.compress(np.ascontiguousarray(counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def _tables(shared):
    """A task's share of the bit counts, in blocks of slots."""

    def blocks(counts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for number, table in enumerate(counts):
            for block, part in enumerate(np.split(table, len(table) >> BLOCK_BITS)):
                if part.any():
                    yield pa.RecordBatch.from_pydict({"predictor": [number], "block": [block], "counts": [_packed(part.ravel())]})
            table[:] = 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        counts = [np.zeros((1 << size, 2), np.uint32) for size in SLOT_BITS]
        held = 0
        for nodes, left in _nodes(batches):
            found = [nodes.entries(i) for i in range(N_PREDICTORS)]
            follows = {i: nodes.followed(marks[i], i) for i in marks}
            while left.any():
                # As much of the counts as there is room for; the rest after handing them on.
                part = np.diff(np.minimum(np.cumsum(left), MOST_COUNTED - held), prepend=0)
                held, left = held + int(part.sum()), left - part
                tallies = nodes.tallied(part)
                by_state, by_node = tallies[nodes.node, nodes.state], tallies.sum(axis=1)
                for number, (table, at) in enumerate(zip(counts, found)):
                    weight = (by_state if number in STATEFUL else by_node).astype(np.uint32)
                    weight = np.repeat(weight, 8).reshape(-1, 8)
                    kept = follows.get(number, slice(None))
                    np.add.at(table.reshape(-1), at[kept].ravel(), weight[kept].ravel())
                if held == MOST_COUNTED:
                    yield from blocks(counts)
                    held = 0
        if held:
            yield from blocks(counts)

    return run


def _summed(key: tuple, shares: pa.Table) -> pa.Table:
    total = np.zeros(2 << BLOCK_BITS, np.float64)
    for part in shares.column("counts"):
        total += _unpacked(part.as_py())
    packed = _packed(total.astype(np.float32).view(np.uint32))
    return pa.Table.from_pydict({"predictor": [key[0].as_py()], "block": [key[1].as_py()], "counts": [packed]})


def _stretched(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = zeros + ones
    return np.log((ones + 0.1) / (zeros + 0.1)), np.minimum(2 * np.log2(1 + total), CONFIDENCES - 1).astype(np.uint8)


def _bucket(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.clip(mixed * 1.5 + REFINED // 2, 0, REFINED - 1.001)
    low = place.astype(np.int64)
    return low, (place - low).astype(np.float32)


#: Sizes of what a pass sums up: loss, slopes, hits and sightings by bucket; curvature.
SUM_SIZES = (1, N_PREDICTORS * 8 * CONFIDENCES, 2 * 256 * REFINED)
CURVE_SIZE = N_PREDICTORS * N_PREDICTORS * 8 * CONFIDENCES * CONFIDENCES


def _without_itself(table: np.ndarray) -> np.ndarray:
    """Per slot the prediction without one bit of 0, and of 1, each beside its confidence.

    One look-up finds both: confidences are the upper halves, predictions the lower.
    """
    both = np.empty((*table.shape, 2), np.float32)
    for bit in (0, 1):
        zeros, ones = np.maximum(table[:, 0] - (1 - bit), 0), np.maximum(table[:, 1] - bit, 0)
        both[:, bit, 0] = _stretched(zeros, ones)[0]
    sure = _stretched(np.maximum(table.sum(axis=1) - 1, 0), np.zeros(1, np.float32))[1]
    both.view(np.int32)[:, :, 1] = sure[:, None]
    return both.view(np.int64).ravel()


def _parted(odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Predictions and confidences that were looked up together."""
    return odds.view(np.float32)[..., ::2], odds >> 32


class Odds:
    """Predictions of all slots without a bit of their own, sent as packed counts."""

    def __init__(self, counts: list[np.ndarray], marks: dict[int, np.ndarray]):
        self.marks, self.tables = marks, None
        self.packed = [_packed(table.view(np.uint32).ravel()) for table in counts]

    def unpacked(self) -> list[np.ndarray]:
        if self.tables is None:
            self.tables = [_without_itself(_unpacked(p).view(np.float32).reshape(-1, 2)) for p in self.packed]
        return self.tables


def _gradients(shared, weights: np.ndarray, curved: bool):
    """A task's share of what a pass sums up under the given weights."""
    by_gate = weights.transpose(1, 0, 2).reshape(N_PREDICTORS, -1)
    gate_places = np.arange(8) * CONFIDENCES

    def curve_of(some, others, found, gates, bend, curve) -> None:
        """Add how the loss curves between the weights of ``some`` predictors and of ``others``."""
        parts = {i: _parted(found[i]) for i in {*some, *others}}
        parts = {i: (stretch.ravel().astype(np.float64), confidence.ravel()) for i, (stretch, confidence) in parts.items()}
        for i in some:
            bent, wide = bend * parts[i][0], gates[i].ravel() * CONFIDENCES
            for k in others:
                if k > i and k in some:
                    continue
                part = np.bincount(wide + parts[k][1], bent * parts[k][0], curve.shape[2])
                if k <= i:
                    curve[i, k] += part
                else:
                    curve[k, i] += part.reshape(8, CONFIDENCES, CONFIDENCES).transpose(0, 2, 1).ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, marks = shared.value.unpacked(), shared.value.marks
        total = np.zeros(sum(SUM_SIZES) + curved * CURVE_SIZE)
        loss, slope, hits, curve = np.split(total, np.cumsum(SUM_SIZES))
        slope, hits = slope.reshape(N_PREDICTORS, -1), hits.reshape(2, -1)
        curve = curve.reshape(N_PREDICTORS, N_PREDICTORS, curved * 8 * CONFIDENCES**2)
        for nodes, _ in _nodes(batches):
            follows = {i: nodes.followed(marks[i], i) for i in marks}
            for own, pairs in nodes.parts():
                node = nodes.node[pairs] - own.start
                heavy, bit = np.repeat(nodes.heavy[pairs], 8), nodes.bits[own].take(node, axis=0).ravel()
                mixed = np.zeros((len(node), 8), np.float32)
                found, gates = [], []
                for i in range(N_PREDICTORS):
                    at = odds[i].take(nodes.entries(i, own, pairs))
                    if i in marks:
                        at *= follows[i][pairs if i in STATEFUL else own]
                    stretch, confidence = _parted(at)
                    confidence += gate_places
                    term = by_gate[i].take(confidence)
                    term *= stretch
                    mixed += term if i in STATEFUL else term.take(node, axis=0)
                    found.append(at)
                    gates.append(confidence)
                mixed = np.clip(mixed, -20, 20).ravel()
                guess = np.exp(-mixed.astype(np.float64))
                guess += 1
                np.reciprocal(guess, out=guess)
                error = bit - guess
                # A bit of 1 was given the chance 1 - error, one of 0 the chance 1 + error.
                loss[0] -= heavy @ np.log1p(-np.abs(error))
                error *= heavy
                bend = (guess - guess * guess) * heavy
                # What leaves the state out is summed over states first.
                begins = np.searchsorted(node, np.arange(own.stop - own.start))
                summed = [np.add.reduceat(x.reshape(-1, 8), begins).ravel() for x in (error, bend)]
                alone = {i: found[i].view(np.float32)[:, ::2].astype(np.float64).ravel() for i in STATELESS}
                for i in STATELESS:
                    slope[i] += np.bincount(gates[i].ravel(), summed[0] * alone[i], slope.shape[1])
                for i in STATEFUL:
                    stretch = found[i].view(np.float32)[:, ::2].ravel()
                    slope[i] += np.bincount(gates[i].ravel(), error * stretch, slope.shape[1])
                if curved:
                    curve_of(STATELESS, STATELESS, found, gates, summed[1], curve)
                    for i in STATELESS:
                        found[i], gates[i] = found[i].take(node, axis=0), gates[i].take(node, axis=0)
                    curve_of(STATEFUL, range(N_PREDICTORS), found, gates, bend, curve)
                low, share = _bucket(mixed)
                low += nodes.known[own].take(node, axis=0).ravel() * REFINED
                above = share * heavy
                for at, amount in ((low, heavy - above), (low + 1, above)):
                    hits[0] += np.bincount(at, amount * bit, hits.shape[1])
                    hits[1] += np.bincount(at, amount, hits.shape[1])
        parts = np.array_split(total, SUM_PARTS)
        yield pa.RecordBatch.from_pydict({"part": list(range(SUM_PARTS)), "sums": [p.tobytes() for p in parts]})

    return run


def _added(key: tuple, shares: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(part.as_py()) for part in shares.column("sums"))
    return pa.Table.from_pydict({"part": [key[0].as_py()], "sums": [total.tobytes()]})


class Mixer:
    """Frozen predictors, mixing weights and the refining table."""

    def __init__(self, counts: list[np.ndarray], marks: dict[int, np.ndarray]):
        self.marks, self.terms = marks, []
        self.weights = np.full((8, N_PREDICTORS, CONFIDENCES), 1.0 / N_PREDICTORS, np.float32)
        grid = (np.arange(REFINED) - REFINED // 2) / 1.5
        self.refined = np.repeat((1 / (1 + np.exp(-grid)))[None, :], 256, axis=0).astype(np.float32)

    def step(self, slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
        """Newton's step from the sums of a pass; gates of different places do not meet."""
        n_gates = N_PREDICTORS * CONFIDENCES
        moved = self.weights.astype(np.float64)
        slope = slope.reshape(N_PREDICTORS, 8, CONFIDENCES)
        curve = curve.reshape(N_PREDICTORS, N_PREDICTORS, 8, CONFIDENCES, CONFIDENCES)
        for place in range(8):
            lower = curve[:, :, place].transpose(0, 2, 1, 3).reshape(n_gates, n_gates)
            full = np.tril(lower) + np.tril(lower, -1).T + PRIOR * np.eye(n_gates)
            away = (moved[place] - 1.0 / N_PREDICTORS).ravel()
            moved[place] += np.linalg.solve(full, slope[:, place].ravel() - PRIOR * away).reshape(moved[place].shape)
        return moved.astype(np.float32)

    def learn(self, spark: SparkSession, pairs: DataFrame, counts: list[np.ndarray]) -> float:
        """Weights and refining table from all pairs; returns the tokens' bits that were seen.

        Each pair is predicted from the counts without one occurrence of itself.
        """
        odds = spark.sparkContext.broadcast(Odds(counts, self.marks))
        dealt = pairs.coalesce(max(1, spark.sparkContext.defaultParallelism))
        best = np.inf
        for number in range(PASSES):
            curved = number < CURVED_PASSES
            sums = dealt.mapInArrow(_gradients(odds, self.weights, curved), "part long, sums binary")
            rows = sums.groupBy("part").applyInArrow(_added, "part long, sums binary").collect()
            total = np.concatenate([np.frombuffer(row["sums"]) for row in sorted(rows, key=lambda row: row["part"])])
            loss, slope, hits, curve = np.split(total, np.cumsum(SUM_SIZES))
            bends = curve if curved else bends
            loss = loss[0] + PRIOR / 2 * float(((self.weights - 1.0 / N_PREDICTORS) ** 2).sum())
            if loss < best:
                best, kept, kept_hits = loss, self.weights, hits.reshape(2, 256, REFINED)
                self.weights = self.step(slope, bends)
            else:
                self.weights = (self.weights + kept) / 2
        odds.destroy()
        self.weights = kept
        self.freeze(counts)
        # Buckets that were hardly seen stay near what the mix itself says.
        self.refined = ((kept_hits[0] + 20 * self.refined) / (kept_hits[1] + 20)).astype(np.float32)
        return float(kept_hits[1].sum())

    def freeze(self, counts: list[np.ndarray]) -> None:
        """What every slot adds to the mix: its prediction under the weight of its gate."""
        self.terms = []
        for i, table in enumerate(counts):
            place = np.arange(len(table)) % 8
            stretch, confidence = _stretched(table[:, 0], table[:, 1])
            self.terms.append((self.weights[place, i, confidence] * stretch).astype(np.float32))

    def bits(self, data: np.ndarray, offsets: np.ndarray, states: np.ndarray) -> np.ndarray:
        """The code length of each spelled word under its state, in bits."""
        rows = np.arange(len(states))
        nodes = Nodes(data, offsets, rows, states, np.ones(len(rows)))
        table, cost = self.refined.reshape(-1), np.zeros(len(nodes.fresh) * STATES)
        follows = {i: nodes.followed(self.marks[i], i) for i in self.marks}
        for own, pairs in nodes.parts():
            node = nodes.node[pairs] - own.start
            mixed = np.zeros((len(node), 8), np.float32)
            for i in range(N_PREDICTORS):
                term = self.terms[i].take(nodes.entries(i, own, pairs) >> 1)
                if i in follows:
                    term = term * follows[i][pairs if i in STATEFUL else own]
                mixed += term if i in STATEFUL else term.take(node, axis=0)
            mixed = np.clip(mixed, -20, 20)
            low, share = _bucket(mixed)
            flat_at = nodes.known[own].take(node, axis=0) * REFINED + low
            refined = table.take(flat_at) * (1 - share) + table.take(flat_at + 1) * share
            guess = np.clip((refined + 1 / (1 + np.exp(-mixed))) / 2, 1e-6, 1 - 1e-6)
            chance = np.where(nodes.bits[own].take(node, axis=0) == 1, guess, 1 - guess)
            cost[nodes.node[pairs] * STATES + nodes.state[pairs]] = -np.log2(chance).sum(axis=1, dtype=np.float64)
        each = cost.take(nodes.owner * STATES + np.repeat(states, np.diff(offsets)))
        sums = np.concatenate(([0.0], np.cumsum(each)))
        return sums[offsets[1:]] - sums[offsets[:-1]]


def _tokens(batch: pa.RecordBatch, hasher: Hasher):
    """Words of a batch: folded bytes, starts, ends, rows, hashes, states; end states."""
    data, offsets = flat(batch.column("text"))
    starts, ends, rows = words(data, offsets)
    hashes = hasher(data, starts, ends)
    short = ends - starts <= STATE_WORD_BYTES
    number = np.arange(len(starts))
    last = np.maximum.accumulate(np.where(short, number, -1)) if len(number) else number
    first_of = np.searchsorted(rows, np.arange(batch.num_rows))
    after = np.where((last >= first_of[rows]) & (last >= 0), 1 + (hashes[last] % U64(STATES - 1)).astype(np.int64), 0)
    before = np.concatenate(([0], after[:-1])) if len(after) else after
    before[first_of[first_of < len(rows)]] = 0
    counts = np.bincount(rows, minlength=batch.num_rows)
    at_end = np.where(counts > 0, np.append(after, 0)[np.maximum(first_of + counts - 1, 0)], 0)
    folded = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    return folded, starts, ends, rows, hashes, before, at_end


def _with_end(texts: pa.Array, n: int) -> pa.Array:
    return pa.concat_arrays([texts, pa.array([END] * n, pa.string())])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word follows each state, added up over some pieces of text at a time."""
    hasher, held = Hasher(), []
    end = hasher(np.frombuffer(END.encode(), np.uint8), np.array([0]), np.array([len(END)]))
    for batch in pieces(batches, "text"):
        data, starts, ends, _, hashes, states, at_end = _tokens(batch, hasher)
        keys, first, counts = np.unique(mix(hashes + states.astype(U64)), return_index=True, return_counts=True)
        end_states, end_counts = np.unique(at_end, return_counts=True)
        held.append(
            (
                np.concatenate((keys, mix(end + end_states.astype(U64)))),
                np.concatenate((states[first], end_states)),
                _with_end(strings(*gather(data, starts[first], ends[first])), len(end_states)),
                np.concatenate((counts, end_counts)),
            )
        )
        if sum(len(x[0]) for x in held) >= HELD_PAIRS or sum(x[2].nbytes for x in held) >= HELD_BYTES:
            yield _added_up(held)
            held = []
    if held:
        yield _added_up(held)


def _added_up(held: list[tuple]) -> pa.RecordBatch:
    keys, states, texts, counts = zip(*held)
    _, first, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    n = np.zeros(len(first), np.int64)
    np.add.at(n, which, np.concatenate(counts))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(states)[first], pa.int32()), pa.concat_arrays(texts).take(pa.array(first)), pa.array(n)],
        names=["state", "word", "n"],
    )


def _keys(words_: pa.Array) -> np.ndarray:
    """Hashes of words, some thousand at a time."""
    hasher, keys = Hasher(), np.empty(len(words_), U64)
    for lo in range(0, len(words_), 4096):
        data, offsets = flat(words_.slice(lo, 4096))
        keys[lo : lo + 4096] = hasher(data, offsets[:-1], offsets[1:])
    return keys


class Frequent:
    """The most frequent words with their counts, and their costs in the states met."""

    def __init__(self, counts: pa.Table, end_count: int, costs: pa.Table, mixer: Mixer):
        counts = counts.filter(pc.not_equal(counts.column("word"), END))
        keys = _keys(_whole(counts.column("word")))
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.counts = counts.column("count").to_numpy()[order]
        self.end_count = end_count
        self.cost = np.full((len(order) + 1, STATES), np.nan, np.float32)
        at = np.searchsorted(self.keys, costs.column("key").to_numpy().view(U64))
        self.cost[at, costs.column("state").to_numpy()] = costs.column("cost").to_numpy()
        ends = _spelled(np.full(STATES, ord(END), np.uint8), np.arange(STATES + 1))
        self.cost[-1] = mixer.bits(*ends, np.arange(STATES))
        # Where to begin among the keys, by the first bits of a hash; one more key ends the search.
        bits = min(22, 2 + len(order).bit_length())
        self.shift = U64(64 - bits)
        self.begin = np.searchsorted(self.keys >> self.shift, np.arange(1 << bits, dtype=U64))
        self.keys = np.append(self.keys, ~U64(0))

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each hash, the first key that is not smaller, and whether it is a frequent word's."""
        at = self.begin.take((hashes >> self.shift).astype(np.int64))
        there = self.keys.take(at)
        left = np.flatnonzero(there < hashes)
        while len(left):
            at[left] += 1
            there[left] = self.keys.take(at[left])
            left = left[there[left] < hashes[left]]
        return at, (there == hashes) & (at < len(self.counts))


def _split(shared, total: int, distinct: int):
    """Per row: sums over its frequent words, and its other words as rows of their own."""
    floor = np.log10(total + distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, hasher = shared.value, Hasher()
        row_id = TaskContext.get().partitionId() << 40
        gain = np.log10(frequent.counts + 1.0)
        for batch in pieces(batches, "text"):
            n_rows = batch.num_rows
            data, starts, ends, rows, hashes, states, at_end = _tokens(batch, hasher)
            at, common = frequent.places(hashes)
            common &= ~np.isnan(frequent.cost.ravel().take(at * STATES + states))
            at, own = at[common], rows[common]
            per_row = np.bincount(rows, minlength=n_rows)
            end_gain = np.log10(frequent.end_count + 1.0)
            base = np.bincount(own, gain[at], n_rows) + end_gain - (per_row + 1) * floor
            cost = np.bincount(own, frequent.cost[at, states[common]], n_rows) + frequent.cost[-1, at_end]
            known = np.bincount(own, minlength=n_rows) + (frequent.end_count > 0)
            ids = row_id + np.arange(n_rows)
            row_id += n_rows
            rare = np.flatnonzero(~common)
            _, first, n = np.unique(
                mix(mix(hashes[rare] + states[rare].astype(U64)) + rows[rare].astype(U64)),
                return_index=True,
                return_counts=True,
            )
            first = rare[first]
            texts = strings(*gather(data, starts[first], ends[first]))
            n_rare = len(first)
            sizes = np.diff(flat(batch.column("text"))[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((ids, ids[rows[first]]))),
                    pa.concat_arrays([batch.column("doc_id").cast(pa.int64()), pa.nulls(n_rare, pa.int64())]),
                    pa.concat_arrays([pa.nulls(n_rows, pa.string()), texts]),
                    pa.array(np.concatenate((np.zeros(n_rows, int), states[first])), pa.int32()),
                    pa.array(np.concatenate((per_row + 1, n)), pa.int64()),
                    pa.array(np.concatenate((base, np.zeros(n_rare)))),
                    pa.array(np.concatenate((cost, np.zeros(n_rare)))),
                    pa.array(np.concatenate((known, np.zeros(n_rare, int))), pa.int64()),
                    pa.array(np.concatenate((sizes, np.zeros(n_rare, int))), pa.int64()),
                ],
                names=["row_id", "doc_id", "word", "state", "n", "base", "cost", "known", "n_bytes"],
            )

    return run


def _whole(column: pa.ChunkedArray) -> pa.Array | np.ndarray:
    """A column in one piece; numbers as numpy has them."""
    if pa.types.is_string(column.type):
        return pa.concat_arrays([pa.array([], pa.string()), *column.chunks])
    return column.to_numpy()


def _distinct_costs(batch: pa.RecordBatch, data, offsets, states, mixer: Mixer, hasher: Hasher) -> np.ndarray:
    """The cost of each row's word. Rows arrive by word, so equal ones meet in a batch."""
    key = mix(hasher(data, offsets[:-1], offsets[1:]) + states.astype(U64))
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    order = np.argsort(first)  # as they came: by word
    first, cost = first[order], np.empty(len(order))
    cost[order] = mixer.bits(*gather(data, offsets[first], offsets[first + 1]), states[first])
    return cost[which]


def _cost(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, hasher = shared.value, Hasher(fold_case=False)
        for batch, data, offsets, states in _pair_pieces(batches):
            cost = _distinct_costs(batch, data, offsets, states, mixer, hasher)
            n, count = batch.column("n").to_numpy(), batch.column("count").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_id"),
                    pa.array(n * np.log10(count + 1.0)),
                    pa.array(n * cost),
                    pa.array(np.where(count > 0, n, 0)),
                ],
                names=["row_id", "base", "cost", "known"],
            )

    return run


def _pair_cost(shared):
    """Costs of words by their hashes, which is all that looking them up takes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch, data, offsets, states in _pair_pieces(batches):
            cost = shared.value.bits(data, offsets, states).astype(np.float32)
            keys = hasher(data, offsets[:-1], offsets[1:] - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), batch.column("state"), pa.array(cost)], names=["key", "state", "cost"]
            )

    return run


def score_texts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Log-probabilities of every text of ``docs (doc_id, text, held_out)``.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    n_bytes and bits_per_byte. Learning uses the rows whose ``held_out`` is false, all
    of them: counts of every word after every state, and from these the tables of all
    predictors. The tables have a fixed size, so that they can be sent to every task.
    The mixing weights and the refining table are learned from all pairs as well, by sums
    that the tasks work out in ``PASSES`` passes.

    Frequent words (``FREQUENT_SHARE``) are summed where the text is read. All others,
    each rare then, travel once to their counts and back as sums, so no word and no text
    meets a task with more than its share of the rows.

    Very long texts are scored whole, one at a time; an empty table gives an empty one.
    A null or blank text is the end alone. ``held_out`` null counts as false. Each row
    gives a row, also when rows are equal or have no id. Nothing to learn from: every
    predictor is even, and the base score that of unseen tokens.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce("held_out", F.lit(False)).alias("held_out"),
    )
    learned = docs.where("not held_out").select("text").mapInArrow(_pairs, "state int, word string, n long")
    pairs = learned.groupBy("state", "word").agg(F.sum("n").alias("n"))
    pairs = written(spark, pairs, "sums")  # borders between ranges are drawn from its rows
    pairs = pairs.repartitionByRange("word", "state").sortWithinPartitions("word", "state")
    pairs = written(spark, pairs, "pairs")
    counts = written(spark, pairs.groupBy("word").agg(F.sum("n").alias("count")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()

    frequent = counts.where(F.col("count") >= total * FREQUENT_SHARE)
    listed = frequent.select("word", "count").toArrow()
    told = spark.sparkContext.broadcast({})
    # One set of tables per core of the cluster, whatever the number of pairs.
    shares = pairs.coalesce(max(1, spark.sparkContext.defaultParallelism)).mapInArrow(
        _tables(told), "predictor long, block long, counts binary"
    )
    blocks = shares.groupBy("predictor", "block").applyInArrow(_summed, "predictor long, block long, counts binary")
    tables = [np.zeros((1 << size, 2), np.float32) for size in SLOT_BITS]
    for row in blocks.toLocalIterator():
        at = row["block"] << BLOCK_BITS
        tables[row["predictor"]][at : at + (1 << BLOCK_BITS)] = _unpacked(row["counts"]).view(np.float32).reshape(-1, 2)

    told.destroy()
    mixer = Mixer(tables, {})
    if total:
        mixer.learn(spark, pairs, tables)
    else:
        mixer.freeze(tables)
    del tables
    ends = counts.where(F.col("word") == END).first()
    model = spark.sparkContext.broadcast(mixer)
    met = pairs.select("state", "word").where(F.col("word") != END)
    met = met.join(frequent.select("word"), "word", "left_semi").select("state", "word")
    met = met.sortWithinPartitions("word", "state")
    costs = met.mapInArrow(_pair_cost(model), "key long, state int, cost float").toArrow()
    head = spark.sparkContext.broadcast(Frequent(listed, ends["count"] if ends else 0, costs, mixer))
    del listed, costs, mixer

    parts = written(
        spark,
        docs.select("doc_id", "text").mapInArrow(
            _split(head, total, distinct),
            "row_id long, doc_id long, word string, state int, n long, base double, cost double, known long, n_bytes long",
        ),
        "parts",
    )
    rare = parts.where("word is not null").select("row_id", "word", "state", "n").join(counts, "word", "left")
    rare = rare.select("row_id", "word", "state", "n", F.coalesce("count", F.lit(0)).alias("count"))
    rare = rare.mapInArrow(_cost(model), "row_id long, base double, cost double, known long")
    heads = parts.where("word is null").select("row_id", "doc_id", "n", "base", "cost", "known", "n_bytes")
    sums = rare.groupBy("row_id").agg(*(F.sum(c).alias(f"rare_{c}") for c in ("base", "cost", "known")))
    scored = heads.join(sums, "row_id", "left")
    both = {c: F.col(c) + F.coalesce(f"rare_{c}", F.lit(0)) for c in ("base", "cost", "known")}
    return scored.select(
        "doc_id",
        F.col("n").alias("n_tokens"),
        both["known"].alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        both["base"].alias("base_score"),
        (both["cost"] * -LOG10_2).alias("score"),
        "n_bytes",
        F.when(F.col("n_bytes") > 0, both["cost"] / F.col("n_bytes")).alias("bits_per_byte"),
    )
