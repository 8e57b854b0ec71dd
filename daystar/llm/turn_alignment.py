"""Wagner-Fischer alignment of speaker turns to the alternating targets `(s?(ua)+)?`.

Turns are given by the initials of their roles. Edits and what they cost: keep 0, rerole to user
or assistant 1, delete 2 (required for some turns), insert a turn 5; a turn may cost more
unless it is deleted. All targets end in the same alternation, so one matrix, counted from
the end, holds the alignment to the target of each length; Ukkonen's band leaves out the
cells that no alignment as cheap as one already known can pass.

A long conversation may be cut into pieces: `transitions` aligns a piece from any phase of
the alternation to any other, and `Chain` joins the results in order.
"""

from __future__ import annotations

import numpy as np

#: Phases of the alternation: nothing said, a system turn said, a user turn last, an assistant turn last.
START, OPENED, ASKED, ANSWERED = PHASES = range(4)
REROLE, DELETE, INSERT = 1, 2, 5
OTHER = {"u": "a", "a": "u"}
FAR = 1 << 30


def _next_symbol(phase):
    return "a" if phase == ASKED else "u"


def _incumbent(initials, required, extra, first, last):
    """Cost of some alignment to an alternation from `first` to `last`: the better of two plain ones.

    One deletes every turn that does not fit, the other reroles it; a turn too few is inserted.
    """
    costs = []
    for fit in (DELETE, REROLE):
        cost, wanted, said = 0, first, False
        for initial, must, more in zip(initials, required, extra, strict=True):
            if must:
                cost += DELETE
            elif fit == REROLE or (initial == wanted and not more):
                cost += more + (REROLE if initial != wanted else 0)
                wanted, said = OTHER[wanted], True
            else:
                cost += DELETE
        if not said:
            cost, wanted = cost + INSERT, OTHER[wanted]
        costs.append(cost + (INSERT if wanted == last else 0))
    return min(costs)


class Matrix:
    """Least cost of aligning the turns from i on to the last r symbols of an alternation ending in `last`.

    Exact for every cell on an alignment of all turns that costs at most `most`; a cell outside
    the band reads as FAR.
    """

    def __init__(self, initials, required, extra, last, most):
        self.initials, self.required, self.extra, self.last = initials, required, extra, last
        size = len(initials)
        free = [0] * (size + 1)
        for at in range(size - 1, -1, -1):
            free[at] = free[at + 1] + (not required[at])
        spare = max(most - DELETE * (size - free[0]), 0)
        below, above = spare // DELETE, spare // INSERT
        self._low = [max(0, n - below) for n in free]
        self._rows = [None] * (size + 1)
        row = np.arange(above + 1, dtype=np.int32) * INSERT
        self._rows[size] = row
        for at in range(size - 1, -1, -1):
            low, high = self._low[at], free[at] + above
            before = self._low[at + 1]
            # Cells before - 1 to high of the row below, FAR outside its band.
            padded = np.full(high - before + 2, FAR, dtype=np.int32)
            padded[1 : len(row) + 1] = row[: len(padded) - 1]
            lengths = np.arange(low, high + 1)
            best = padded[lengths - before + 1] + DELETE
            if not required[at]:
                unlike = np.where(lengths % 2 == 1, initials[at] != last, initials[at] != OTHER[last])
                moved = padded[lengths - before] + extra[at] + unlike
                moved[lengths == 0] = FAR
                best = np.minimum(best, moved)
            slope = (lengths * INSERT).astype(np.int32)
            row = np.minimum.accumulate(best - slope) + slope
            self._rows[at] = row.astype(np.int32)
            row = self._rows[at]

    def cost(self, at, length):
        index = length - self._low[at]
        row = self._rows[at]
        return int(row[index]) if 0 <= index < len(row) else FAR

    def least(self, at, parity, shortest):
        """(cost, lengths): least cost from turn `at` over targets of a parity and least length."""
        row = self._rows[at]
        lengths = np.arange(self._low[at], self._low[at] + len(row))
        fits = (lengths % 2 == parity) & (lengths >= shortest)
        if not fits.any():
            return FAR, []
        best = int(row[fits].min())
        return best, lengths[fits & (row == best)].tolist() if best < FAR // 2 else []

    def audit(self, at, length):
        """The ASCII-least string of edits among the cheapest ones from a cell."""
        out, size, now = [], len(self.initials), self.cost(at, length)
        while at < size or length:
            if at < size and (after := self.cost(at + 1, length)) + DELETE == now:
                out.append("D")
                at += 1
            elif length and (after := self.cost(at, length - 1)) + INSERT == now:
                out.append("I")
                length -= 1
            else:
                wanted = self.last if length % 2 else OTHER[self.last]
                out.append("K" if self.initials[at] == wanted else "R")
                after = self.cost(at + 1, length - 1)
                at, length = at + 1, length - 1
            now = after
        return "".join(out)


def transitions(initials, required, extra, entries=PHASES, exits=PHASES):
    """{(entry, exit): (cost, audit)}: the cheapest edits of the turns, ties to the ASCII-least.

    `initials` are the first letters of the roles; `required` says which turns must be deleted and
    `extra` what a turn costs besides unless it is deleted.
    """
    size = len(initials)
    found = {}

    def offer(entry, leave, cost, audit):
        old = found.get((entry, leave))
        if old is None or (cost, audit) < old:
            found[entry, leave] = (cost, audit)

    openers = [i for i in range(size) if initials[i] == "s" and not required[i]] if START in entries else []
    for phase in entries:
        if phase in exits:
            offer(phase, phase, DELETE * size, "D" * size)
    if OPENED in exits and START in entries:
        for at in openers:
            offer(START, OPENED, DELETE * (size - 1) + extra[at], "D" * at + "K" + "D" * (size - at - 1))
    for leave, last in ((ASKED, "u"), (ANSWERED, "a")):
        if leave not in exits:
            continue
        firsts = {_next_symbol(entry) for entry in entries}
        most = max(_incumbent(initials, required, extra, first, last) for first in firsts)
        matrix = Matrix(initials, required, extra, last, most)
        for entry in entries:
            first = _next_symbol(entry)
            parity = 1 if first == last else 0
            starts = [(0, 0, "")]
            if entry == START:
                starts += [(at + 1, DELETE * at + extra[at], "D" * at + "K") for at in openers]
            offered = [(before + matrix.least(at, parity, 1)[0], -at, at, lead) for at, before, lead in starts]
            best = min(cost for cost, *_ in offered)
            if best >= FAR // 2:
                continue
            # The latest opener has the least audit: it deletes where another keeps.
            plain = [o for o in offered if o[0] == best and not o[3]]
            opened = sorted(o for o in offered if o[0] == best and o[3])[:1]
            for _, _, at, lead in plain + opened:
                for length in matrix.least(at, parity, 1)[1]:
                    offer(entry, leave, best, lead + matrix.audit(at, length))
    return found


class Chain:
    """Joins pieces of one conversation in order; memory is that of the audits that are still possible.

    A best audit of a piece is never the start of another one of the same piece and phases (only
    costly inserts could follow), so the least whole audit is made of least parts.
    """

    def __init__(self):
        self._paths = {START: (0, None)}

    def add(self, found):
        """`found` is what `transitions` gave for the next piece."""
        paths = {}
        for (entry, leave), (cost, audit) in found.items():
            if entry in self._paths:
                before, way = self._paths[entry]
                path = (before + cost, (way, audit, entry))
                if leave not in paths or self._less(path, paths[leave]):
                    paths[leave] = path
        self._paths = paths

    @staticmethod
    def _less(one, two):
        if one[0] != two[0]:
            return one[0] < two[0]
        left, right, a, b = [], [], one[1], two[1]
        while a is not b:
            left.append(a[1])
            right.append(b[1])
            a, b = a[0], b[0]
        return "".join(reversed(left)) < "".join(reversed(right))

    def best(self):
        """(cost, audit and entry phase of every piece) of the cheapest whole repair."""
        ends = [self._paths[phase] for phase in (START, ANSWERED) if phase in self._paths]
        best = ends[0]
        for path in ends[1:]:
            if self._less(path, best):
                best = path
        parts, way = [], best[1]
        while way is not None:
            way, audit, entry = way
            parts.append((audit, entry))
        return best[0], parts[::-1]


def applied(audit, turns, phase=START):
    """The turns (role, text) that an audit leaves of a piece entered in a phase."""
    out, at, wanted = [], 0, _next_symbol(phase)
    full = {"u": "user", "a": "assistant"}
    for edit in audit:
        if edit == "D":
            at += 1
        elif edit == "K":
            out.append(turns[at])
            wanted = "u" if turns[at][0][:1] == "s" else OTHER[wanted]
            at += 1
        else:
            out.append((full[wanted], "" if edit == "I" else turns[at][1]))
            at += edit == "R"
            wanted = OTHER[wanted]
    return out
