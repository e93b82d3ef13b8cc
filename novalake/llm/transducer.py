"""A minimal acyclic transducer from terms to their ordinals in byte order.

It is built from sorted terms in one go: states that accept the same endings are one state. An arc carries
how many accepted terms come before those that go through it, so the sum along a term's path is its ordinal.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class Transducer:
    """``arcs`` are sorted (state * 256 + byte); ``targets`` and ``outputs`` belong to them; ``final`` is
    by state. The last state is the start."""

    def __init__(self, arcs: np.ndarray, targets: np.ndarray, outputs: np.ndarray, final: np.ndarray):
        self.arcs, self.targets, self.outputs, self.final = arcs, targets, outputs, final

    @classmethod
    def of(cls, terms: Iterable[bytes]) -> Transducer:
        """From distinct terms in ascending order."""
        known: dict[tuple, int] = {}
        path: list[tuple[list, list]] = [([False], [])]  # of the last term: is a state final, its arcs
        last = b""

        def close(down_to: int) -> None:
            while len(path) > down_to + 1:
                final, out = path.pop()
                state = known.setdefault((final[0], tuple(out)), len(known))
                path[-1][1].append((last[len(path) - 1], state))

        for term in terms:
            same = 0
            while same < min(len(last), len(term)) and last[same] == term[same]:
                same += 1
            close(same)
            path.extend(([False], []) for _ in term[same:])
            path[-1][0][0] = True
            last = term
        close(0)
        known.setdefault((path[0][0][0], tuple(path[0][1]), "start"), len(known))

        below, arcs, targets, outputs = np.zeros(len(known), np.int64), [], [], []
        for state, (final, out, *_) in enumerate(known):
            below[state] = final
            for byte, target in out:
                arcs.append(state << 8 | byte)
                targets.append(target)
                outputs.append(below[state])
                below[state] += below[target]
        return cls(np.array(arcs, np.int64), np.array(targets, np.int32), np.array(outputs, np.int64),
                   np.array([key[0] for key in known], bool))

    def packed(self) -> list[bytes]:
        return [self.arcs.tobytes(), self.targets.tobytes(), self.outputs.tobytes(), self.final.tobytes()]

    @classmethod
    def unpacked(cls, parts: list[bytes]) -> Transducer:
        return cls(*(np.frombuffer(p, t) for p, t in zip(parts, (np.int64, np.int32, np.int64, bool))))

    def ordinals(self, terms: list[bytes]) -> np.ndarray:
        """The ordinal of each term, -1 for those not accepted. All terms take their next byte at once."""
        text = np.frombuffer(b"".join(terms), np.uint8)
        lengths = np.fromiter(map(len, terms), np.int64, len(terms))
        starts = np.cumsum(lengths) - lengths
        state = np.full(len(terms), len(self.final) - 1, np.int64)
        total, going, step = np.zeros(len(terms), np.int64), np.flatnonzero(lengths > 0), 0
        while len(going):
            wanted = (state[going] << 8) | text[starts[going] + step]
            at = np.minimum(np.searchsorted(self.arcs, wanted), max(0, len(self.arcs) - 1))
            hit = self.arcs[at] == wanted if len(self.arcs) else np.zeros(len(going), bool)
            state[going[~hit]] = -1
            going, at = going[hit], at[hit]
            state[going] = self.targets[at]
            total[going] += self.outputs[at]
            step += 1
            going = going[lengths[going] > step]
        return np.where((state >= 0) & self.final[state], total, -1)

    def term(self, ordinal: int) -> bytes:
        """The term with this ordinal."""
        state, out = len(self.final) - 1, bytearray()
        while True:
            low, high = np.searchsorted(self.arcs, [state << 8, (state + 1) << 8])
            if self.final[state]:
                if ordinal == 0:
                    return bytes(out)
            # outputs count the state's own term, so the arc to take is the last one not beyond
            at = low + int(np.searchsorted(self.outputs[low:high], ordinal, side="right")) - 1
            ordinal -= int(self.outputs[at])
            out.append(int(self.arcs[at]) & 255)
            state = int(self.targets[at])
