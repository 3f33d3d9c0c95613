"""Small weighted finite-state transducers over tag sequences, with composition and best path."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field


@dataclass
class Transducer:
    """Arcs by state: input symbol to (next state, output symbol, weight). Every state is final."""

    start: object
    arcs: dict[object, dict[str, list[tuple[object, str, float]]]] = field(default_factory=dict)

    def add(self, state, symbol: str, to, out: str, weight: float = 0.0) -> None:
        self.arcs.setdefault(state, {}).setdefault(symbol, []).append((to, out, weight))

    def compose(self, other: Transducer) -> Transducer:
        """What ``other`` makes of the outputs of this one."""
        start = (self.start, other.start)
        made, todo = Transducer(start), [start]
        seen = {start}
        while todo:
            state = todo.pop()
            a, b = state
            for symbol, outs in self.arcs.get(a, {}).items():
                for to_a, middle, w in outs:
                    for to_b, out, v in other.arcs.get(b, {}).get(middle, ()):
                        made.add(state, symbol, (to_a, to_b), out, w + v)
                        if (to_a, to_b) not in seen:
                            seen.add((to_a, to_b))
                            todo.append((to_a, to_b))
        return made

    def best(self, symbols: Iterable[str]) -> tuple[float, list[str]]:
        """Weight and outputs of the heaviest path; ties keep the arc added first."""
        paths: dict[object, tuple[float, tuple | None]] = {self.start: (0.0, None)}
        for symbol in symbols:
            ahead: dict[object, tuple[float, tuple | None]] = {}
            for state, (weight, trail) in paths.items():
                for to, out, w in self.arcs.get(state, {}).get(symbol, ()):
                    if to not in ahead or weight + w > ahead[to][0]:
                        ahead[to] = (weight + w, (out, trail))
            paths = ahead
        if not paths:
            return 0.0, []
        weight, trail = max(paths.values(), key=lambda x: x[0])
        outs = []
        while trail is not None:
            out, trail = trail
            outs.append(out)
        return weight, outs[::-1]
