"""Similarity scores of many string pairs at once, for use inside a Spark task.

Scores follow the indel distance: ``100 * 2 * LCS / (len(a) + len(b))``. The
longest common subsequence is found bit-parallel (Hyyro, 2004), one numpy step
per character of the text, with as many machine words per pair as its needle needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

WORD = 64
LANES = 1 << 16  # machine words handled in one numpy batch
MASKS = 1 << 22  # machine words of needle masks kept at once
STRIDE = 8  # every how many windows are scored before the rest is bounded
KINDS, TIMES = 1 << 14, 16  # parts told apart, and how often each in a text, before they share bits
OWN = 32  # bits that one part has for itself
NEARLY_ALL = 0.97  # a part in so many texts tells none apart
GRID, ACROSS = 1 << 18, 1 << 12  # pairs whose bits are compared at once, and how many of them with one text
CHANCES = 1 << 18  # pairs that few bits are lost of, looked at more closely at once
PRIME = 1000003


class Strings:
    """Strings as one run of character codes; code 0 stands behind the last."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.length = np.array([len(text) for text in texts], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        alphabet, codes = np.unique(points, return_inverse=True)
        self.size = len(alphabet) + 1
        self.codes = np.append(codes + 1, 0).astype(np.int32)

    def at(self, place: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Codes at places of the run, 0 where ``inside`` is false."""
        return self.codes.take(np.where(inside, place, len(self.codes) - 1))

    def words(self, needle: np.ndarray) -> np.ndarray:
        """Machine words that each needle takes."""
        return np.maximum(1, -(-self.length[needle] // WORD))

    def masks(self, needles: np.ndarray, words: int) -> np.ndarray:
        """For each word, needle and character: one bit per place where the needle has it."""
        masks = np.zeros((words, len(needles), self.size), dtype=np.uint64)
        row = np.repeat(np.arange(len(needles)), self.length[needles])
        first = np.concatenate([[0], np.cumsum(self.length[needles])])
        place = np.arange(first[-1]) - first[row]
        code = self.codes[self.start[needles][row] + place]
        np.bitwise_or.at(masks, (place // WORD, row, code), np.uint64(1) << (place % WORD).astype(np.uint64))
        masks[:, :, 0] = 0
        return masks


def lcs(a: str, b: str) -> int:
    """Longest common subsequence of two strings of any length."""
    masks: dict[str, int] = {}
    for at, char in enumerate(a):
        masks[char] = masks.get(char, 0) | (1 << at)
    full = (1 << len(a)) - 1
    row = full
    for char in b:
        hit = row & masks.get(char, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _score(common, total):
    return (1.0 - (total - 2 * common) / total) * 100.0


def _row_lcs(row: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Zero bits among the first ``length`` ones of each lane of words."""
    common = np.zeros(row.shape[1], dtype=np.int64)
    for word, bits in enumerate(row):
        used = np.clip(length - word * WORD, 0, WORD)
        kept = np.where(used >= WORD, ~np.uint64(0), (np.uint64(1) << (used % WORD).astype(np.uint64)) - np.uint64(1))
        common += np.bitwise_count(~bits & kept)
    return common


def _step(row: np.ndarray, masks: np.ndarray, at: np.ndarray) -> None:
    """Read one character: ``masks`` are flat per word, ``at`` is each lane's place in them."""
    carry = np.zeros(row.shape[1], dtype=np.uint64)
    for word, bits in enumerate(row):
        hit = bits & masks[word].take(at)
        added = bits + hit
        total = added + carry
        carry = ((added < bits) | (total < added)).astype(np.uint64)
        row[word] = total | (bits - hit)


def _batches(strings: Strings, needle: np.ndarray, lanes: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """Pairs in batches of like needles: their places, the words they take, their masks, and each one's place in them.

    ``lanes`` says how many lanes each pair brings; a batch has about ``LANES`` words of them.
    """
    words = strings.words(needle)
    for many in np.unique(words).tolist():
        of = np.flatnonzero(words == many)
        of = of[np.argsort(needle[of], kind="stable")]
        most = max(1, MASKS // (many * strings.size))
        number = np.unique(needle[of], return_inverse=True)[1]
        parts = number // most + (number[-1] + 1) * ((np.cumsum(lanes[of]) - 1) * many // LANES)
        for part in np.split(of, np.flatnonzero(np.diff(parts)) + 1):
            held, which = np.unique(needle[part], return_inverse=True)
            yield part, many, strings.masks(held, many).reshape(many, -1), which * strings.size


def ratio(strings: Strings, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Score of whole strings, for index pairs into ``strings``."""
    scores = np.full(len(left), 100.0)
    if not len(left):
        return scores
    swap = strings.length[left] > strings.length[right]
    needles, texts = np.where(swap, right, left), np.where(swap, left, right)
    for part, many, masks, base in _batches(strings, needles, np.ones(len(needles), np.int64)):
        needle, text = needles[part], texts[part]
        row = np.full((many, len(part)), ~np.uint64(0))
        length, start = strings.length[text], strings.start[text]
        for step in range(int(length.max())):
            _step(row, masks, base + strings.at(start + step, step < length))
        total = strings.length[needle] + length
        scores[part] = np.where(total > 0, _score(_row_lcs(row, strings.length[needle]), np.maximum(total, 1)), 100.0)
    return scores


def partial_ratio(
    strings: Strings, left: np.ndarray, right: np.ndarray, least: np.ndarray | None = None
) -> np.ndarray:
    """Best score of the shorter string against the windows of the longer one.

    Windows are all substrings of the shorter one's length and all shorter
    beginnings and endings. Strings of equal length are tried both ways. A
    score below ``least`` may come out lower than it is.
    """
    least = np.zeros(len(left)) if least is None else least
    swap = strings.length[left] > strings.length[right]
    needle, text = np.where(swap, right, left), np.where(swap, left, right)
    scores = _best_window(strings, needle, text, least)
    same = np.flatnonzero(strings.length[left] == strings.length[right])
    if len(same):
        other = _best_window(strings, text[same], needle[same], np.maximum(least[same], scores[same]))
        scores[same] = np.maximum(scores[same], other)
    return scores


def _best_window(strings: Strings, needle: np.ndarray, text: np.ndarray, least: np.ndarray) -> np.ndarray:
    scores = np.zeros(len(needle))
    m, n = strings.length[needle], strings.length[text]
    scores[n == 0] = 100.0
    some = np.flatnonzero(m > 0)
    if len(some):
        for at, many, masks, base in _batches(strings, needle[some], n[some]):
            part = some[at]
            scores[part] = _windows(strings, many, masks, base, needle[part], text[part], least[part])
    return scores


def _windows(strings: Strings, many: int, masks: np.ndarray, base: np.ndarray, needle: np.ndarray, text: np.ndarray, least: np.ndarray):
    """Every STRIDE-th window is scored, and of the others those that can still count.

    Moving a window by one place changes what it shares by one at most.
    """
    m, n = strings.length[needle], strings.length[text]
    first = np.concatenate(([0], np.cumsum(n)[:-1]))
    pair = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(pair)) - first[pair]
    window = np.minimum(m[pair], n[pair] - start)
    probe = np.flatnonzero(start % STRIDE == 0)
    common = np.zeros(len(pair), dtype=np.int64)
    common[probe], best = _lanes(strings, many, masks, base, needle, text, pair[probe], start[probe])
    best = np.maximum(best, 0.0)
    np.maximum.at(best, pair[probe], _score(common[probe], (m[pair] + window)[probe]))

    off = start % STRIDE
    before = np.arange(len(pair)) - off
    most = common[before] + off
    after = before + STRIDE
    known = start - off + STRIDE < n[pair]
    most = np.where(known, np.minimum(most, common[np.minimum(after, len(pair) - 1)] + STRIDE - off), most)
    reach = _score(np.minimum(most, window), m[pair] + window)
    rest = np.flatnonzero((off > 0) & (reach > best[pair]) & (reach >= least[pair] - 1e-9))
    if len(rest):
        shared, _ = _lanes(strings, many, masks, base, needle, text, pair[rest], start[rest])
        np.maximum.at(best, pair[rest], _score(shared, (m[pair] + window)[rest]))
    return best


def _lanes(strings: Strings, many: int, masks: np.ndarray, base: np.ndarray, needle: np.ndarray, text: np.ndarray, pair, start):
    """What each window shares with its needle, and the best score of the beginnings of each pair's text."""
    m, n = strings.length[needle], strings.length[text]
    lane_m = m[pair]
    ends = np.minimum(lane_m, n[pair] - start)
    at, place = strings.start[text[pair]] + start, base[pair]
    heads = np.flatnonzero(start == 0)
    head_m, head_window = lane_m[heads], ends[heads]
    best_head = np.zeros(len(needle))
    row = np.full((many, len(pair)), ~np.uint64(0))
    for step in range(int(ends.max())):
        _step(row, masks, place + strings.at(at + step, step < ends))
        if len(heads):
            score = _score(_row_lcs(row[:, heads], head_m), head_m + step + 1)
            best_head[pair[heads]] = np.maximum(best_head[pair[heads]], np.where(step < head_window, score, 0.0))
    return _row_lcs(row, lane_m), best_head


SCORERS = {"ratio": ratio, "partial": partial_ratio}


class Bits:
    """64 bits for every beginning and every ending of every text, from each part and how many like it came before.

    ``codes`` holds the parts of all texts in one run, ``length`` how many each text has. The parts that tell most
    texts apart have a bit of their own and the others share; parts of nearly all texts have none.
    """

    def __init__(self, codes: np.ndarray, length: np.ndarray):
        self.length, self.start = length, np.cumsum(length) - length
        key = np.repeat(np.arange(len(length)), length) * KINDS + codes % KINDS
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        many = np.diff(first, append=len(key))
        before, behind = np.empty((2, len(key)), np.int64)
        before[order] = np.arange(len(key)) - np.repeat(first, many)
        behind[order] = np.repeat(first + many - 1, many) - np.arange(len(key))
        before, behind = (key % KINDS * TIMES + np.minimum(nth, TIMES - 1) for nth in (before, behind))
        bit_of = self._bit_of(before)
        self.first, self.last = self._gathered(bit_of[before], False), self._gathered(bit_of[behind], True)
        self.whole = self.beginning(np.arange(len(length)), length)

    def _bit_of(self, parts: np.ndarray) -> np.ndarray:
        share = np.bincount(parts, minlength=KINDS * TIMES) / max(1, len(self.length))
        telling = np.flatnonzero((share > 0) & (share < NEARLY_ALL))
        telling = telling[np.argsort(-share[telling] * (1 - share[telling]), kind="stable")]
        rank = np.arange(len(telling))
        bit_of = np.zeros(KINDS * TIMES, np.uint64)
        bit_of[telling] = np.uint64(1) << np.where(rank < OWN, rank, OWN + rank % (WORD - OWN)).astype(np.uint64)
        return bit_of

    def _gathered(self, bits: np.ndarray, backwards: bool) -> np.ndarray:
        """Bits of all parts up to each one, or from each one on; behind them those of no part."""
        for length in np.unique(self.length):
            places = self.start[self.length == length][:, None] + np.arange(length)[:: -1 if backwards else 1]
            bits[places] = np.bitwise_or.accumulate(bits[places], axis=1)
        return np.append(bits, np.uint64(0))

    def beginning(self, text: np.ndarray, parts: np.ndarray) -> np.ndarray:
        parts = np.minimum(parts, self.length[text])
        return self.first[np.where(parts > 0, self.start[text] + parts - 1, -1)]

    def ending(self, text: np.ndarray, parts: np.ndarray) -> np.ndarray:
        parts = np.minimum(parts, self.length[text])
        return self.last[np.where(parts > 0, self.start[text] + self.length[text] - parts, -1)]


def _lost(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Bits that the other lacks: at least so many parts are not shared."""
    return np.bitwise_count(own & ~other).astype(np.int64)


def _few_lost(*tests: tuple[np.ndarray, np.ndarray, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs that pass one of the tests, each at most so many bits that an item of two lists has in common."""
    down, across = len(tests[0][0]), len(tests[0][1])
    for low in range(0, across, ACROSS):
        count = min(ACROSS, across - low)
        # Rows of whole machine words, as eight pairs are passed over at once.
        wide = -(-count // 8) * 8
        high = min(down, max(1, GRID // wide))
        bits, many, few, more = (np.empty((high, wide), kind) for kind in (np.uint64, np.uint8, bool, bool))
        padded = [np.append(column[low : low + count], np.zeros(wide - count, np.uint64)) for _, column, _ in tests]
        for top in range(0, down, high):
            rows = min(high, down - top)
            for nth, ((own, _, most), others) in enumerate(zip(tests, padded)):
                np.bitwise_and(own[top : top + rows, None], others, out=bits[:rows])
                np.bitwise_count(bits[:rows], out=many[:rows])
                np.less_equal(many[:rows], min(most, WORD), out=(more if nth else few)[:rows])
                if nth:
                    few[:rows] |= more[:rows]
            some = np.flatnonzero(few[:rows].view(np.uint64))
            if len(some):
                at, place = np.nonzero(few[:rows].reshape(-1, 8)[some])
                row, column = np.divmod(some[at] * 8 + place, wide)
                there = column < count
                yield row[there] + top, column[there] + low


def _by_length(strings: Strings, of: np.ndarray) -> list[tuple[int, np.ndarray]]:
    of = of[np.argsort(strings.length[of], kind="stable")]
    lengths, first = np.unique(strings.length[of], return_index=True)
    return list(zip(lengths.tolist(), np.split(of, first[1:])))


def _batched(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, about ``CHANCES`` at a time."""
    held, many = [], 0
    for pair in found:
        held.append(pair)
        many += len(pair[0])
        if many >= CHANCES:
            yield tuple(np.concatenate(side) for side in zip(*held))
            held, many = [], 0
    if many:
        yield tuple(np.concatenate(side) for side in zip(*held))


class _Whole:
    """Pairs of whole strings that can reach a cutoff.

    Strings of ``a`` and ``b`` characters may leave so many over. What they
    share lies in one run more at most, and no character of it moved further
    than what is left over on one side.
    """

    def __init__(self, strings: Strings, cutoff: float):
        self.strings, self.cutoff = strings, cutoff

    def common(self, a, b):
        """The least that they share, above the shorter one's length where that is out of reach."""
        spare = np.floor((a + b) * (1 - self.cutoff / 100) + 1e-9).astype(np.int64)
        return (a + b - np.minimum(spare - (spare + a + b) % 2, a + b)) // 2

    def chances(self, ones: Bits, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a, x in _by_length(self.strings, left):
            for b, y in _by_length(self.strings, right):
                most = min(a, b) - int(self.common(np.int64(a), np.int64(b)))
                if most >= 0:
                    own, others = ones.whole[x], ones.whole[y]
                    test = (own, ~others, most) if a <= b else (~own, others, most)
                    yield from ((x[i], y[j]) for i, j in _few_lost(test))

    def tests(self, ones: Bits, twos: Bits) -> tuple[Callable, ...]:
        """Tests of pairs, each for those that passed the ones before."""
        length = self.strings.length

        def bounds(x, y):
            a, b = length[x], length[y]
            common = self.common(a, b)
            return a, b, common, 3 * common - a - b - 1

        def characters(x, y):
            a, b, common, _ = bounds(x, y)
            return (_lost(ones.whole[x], ones.whole[y]) <= a - common) & (_lost(ones.whole[y], ones.whole[x]) <= b - common)

        def neighbours(x, y):
            a, b, _, pairs = bounds(x, y)
            good = (_lost(twos.whole[x], twos.whole[y]) <= a - 1 - pairs) & (_lost(twos.whole[y], twos.whole[x]) <= b - 1 - pairs)
            return good | (pairs <= 0)

        def halves(x, y):
            a, b, common, _ = bounds(x, y)
            half = a // 2
            lost = _lost(ones.beginning(x, half), ones.beginning(y, half + b - common))
            return lost + _lost(ones.ending(x, a - half), ones.ending(y, b - half + a - common)) <= a - common

        return characters, neighbours, halves


class _Partial:
    """Pairs of which the shorter one can reach a cutoff in some window of the longer one.

    A window as long as the needle lies anywhere and must hold most of it; a
    shorter one is a beginning or an ending, of which the needle must hold
    nearly all.
    """

    def __init__(self, strings: Strings, cutoff: float):
        self.strings = strings
        self.lengths = np.unique(strings.length)
        self.bounds = np.array([self._bounds(m, cutoff) for m in self.lengths.tolist()]).reshape(-1, 6)

    @staticmethod
    def _bounds(m: int, cutoff: float) -> list[int]:
        """What a needle of ``m`` characters, and pairs of them, may lose to a full window, and what to a shorter one.

        Then the shortest such window that can match, and what any of them may lose; -1 where there is none.
        """
        window = np.arange(min(m, 1), m + 1)
        common = np.maximum(0, np.ceil(cutoff * (m + window) / 200 - 1e-9)).astype(np.int64)
        pairs = np.maximum(0, 3 * common - m - window - 1)
        found = [m - common[-1], max(0, m - 1) - pairs[-1]]
        can = np.flatnonzero(common[:-1] <= window[:-1])
        if not len(can):
            return [*found, -1, -1, -1, -1]
        return [*found, m - common[can].min(), max(0, m - 1) - pairs[can].min(), window[can[0]], (window - common)[can].max()]

    def chances(self, ones: Bits, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for own, others, turned in ((left, right, False), (right, left, True)):
            others = others[np.argsort(self.strings.length[others], kind="stable")]
            bits, length = ones.whole[others], self.strings.length[others]
            for m, needle in _by_length(self.strings, own):
                same, longer = (slice(*np.searchsorted(length, ends)) for ends in ([m, m + 1], [m + 1, length.max(initial=m) + 1]))
                full, _, part, _, window, lost = self.bounds[np.searchsorted(self.lengths, m)].tolist()
                bits_of = ones.whole[needle]
                tests = [(bits_of, ~bits[longer], full)]
                if part >= 0:
                    ends = (cut(others[longer], np.int64(window)) for cut in (ones.beginning, ones.ending))
                    tests += [(~bits_of, end, lost) for end in ends]
                for i, j in _few_lost(*tests):
                    pair = needle[i], others[longer][j]
                    yield pair[::-1] if turned else pair
                # Of two of one length either may be the needle.
                for i, j in () if turned else _few_lost((bits_of, ~bits[same], max(full, part))):
                    yield needle[i], others[same][j]

    def tests(self, ones: Bits, twos: Bits) -> tuple[Callable, ...]:
        """Tests of pairs, each for those that passed the ones before."""
        length = self.strings.length

        def sides(x, y):
            swap = length[x] > length[y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            return x, y, length[x], self.bounds[np.searchsorted(self.lengths, length[x])].T

        def neighbours(x, y):
            x, y, _, (_, full, _, part, _, _) = sides(x, y)
            return _lost(twos.whole[x], twos.whole[y]) <= np.maximum(full, part)

        def windows(x, y):
            x, y, m, (full, full_pairs, part, part_pairs, window, window_lost) = sides(x, y)
            good = (_lost(ones.whole[x], ones.whole[y]) <= full) & (_lost(twos.whole[x], twos.whole[y]) <= full_pairs)
            good |= length[y] == m
            for cut in ("beginning", "ending"):
                ones_of, twos_of = getattr(ones, cut), getattr(twos, cut)
                part_good = (_lost(ones.whole[x], ones_of(y, m - 1)) <= part) & (_lost(twos.whole[x], twos_of(y, m - 2)) <= part_pairs)
                good |= part_good & (_lost(ones_of(y, window), ones.whole[x]) <= window_lost)
            return good

        return neighbours, windows


def _chances(strings: Strings, split: int, scorer: str, cutoff: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of pairs of one of the first ``split`` strings and one of the others that can reach the cutoff.

    All pairs are told by 64 bits of their characters first, what is left also
    by pairs of neighbours and by where they stand. No bound loses a match.
    """
    ones = Bits(strings.codes[:-1], strings.length)
    last = np.cumsum(strings.length)[strings.length > 0] - 1
    pairs = np.delete(strings.codes[:-1].astype(np.int64) * PRIME + strings.codes[1:], last)
    twos = Bits(pairs, np.maximum(strings.length - 1, 0))
    kind = (_Whole if scorer == "ratio" else _Partial)(strings, cutoff)
    every = np.arange(len(strings.texts))
    for x, y in _batched(kind.chances(ones, every[:split], every[split:])):
        for test in kind.tests(ones, twos):
            good = test(x, y)
            x, y = x[good], y[good]
        if len(x):
            yield x, y


def _bounds(strings: Strings, scorer: str, cutoff: float, left: np.ndarray, right: np.ndarray):
    """Pairs that can still reach the cutoff, with what they can reach at most.

    No window shares more with the shorter string than the whole longer one does.
    """
    if scorer == "ratio":
        return left, right, ratio(strings, left, right)
    m = np.minimum(strings.length[left], strings.length[right])
    whole = ratio(strings, left, right) / 200.0 * (strings.length[left] + strings.length[right])
    common = np.rint(whole)
    most = np.where(m + common > 0, 200.0 * common / np.maximum(m + common, 1), 100.0)
    chance = np.flatnonzero(most >= cutoff - 1e-9)
    return left[chance], right[chance], most[chance]


def match_batches(left: list[str], right: list[str], scorer: str, cutoff: float, best: bool = False):
    """Index pairs that score at least ``cutoff``, with their scores, a bounded number at a time.

    Pairs are scored only if their characters, their neighbours, and then
    their whole common subsequence leave them a chance. With ``best`` only pairs
    that can tie or beat the most promising one of their left string are. No
    bound loses a match.
    """
    strings = Strings(left + right)
    split = len(left)
    score, floor = SCORERS[scorer], np.full(split, float(cutoff))
    for a, b in _chances(strings, split, scorer, cutoff):
        a, b, most = _bounds(strings, scorer, cutoff, a, b)
        if best and len(a):
            worth = most >= floor[a] - 1e-9
            a, b, most = a[worth], b[worth], most[worth]
        if best and scorer != "ratio" and len(a):
            by_promise = np.lexsort((-most, a))
            leads = by_promise[np.unique(a[by_promise], return_index=True)[1]]
            np.maximum.at(floor, a[leads], score(strings, a[leads], b[leads], floor[a[leads]]))
            worth = most >= floor[a] - 1e-9
            a, b, most = a[worth], b[worth], most[worth]
        scores = most if scorer == "ratio" else score(strings, a, b, floor[a])
        if best:
            np.maximum.at(floor, a, scores)
        good = np.flatnonzero(scores >= (floor[a] if best else cutoff))
        yield a[good], b[good] - split, scores[good]


def matches(left: list[str], right: list[str], scorer: str, cutoff: float, best: bool = False):
    """All of ``match_batches`` at once."""
    none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    return tuple(np.concatenate(x) for x in zip(none, *match_batches(left, right, scorer, cutoff, best)))


def pair_scores(left: list[str], right: list[str], scorer: str) -> np.ndarray:
    """Score of each string of one list with the string at the same place of the other."""
    strings = Strings(left + right)
    at = np.arange(len(left))
    return SCORERS[scorer](strings, at, at + len(left))


def indel_ratio(a: str, b: str) -> float:
    """Score of two whole strings."""
    return float(_score(lcs(a, b), len(a) + len(b))) if a or b else 100.0
