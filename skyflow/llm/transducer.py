"""BPE tokenizers compiled to deterministic finite-state transducers.

A token sequence is the BPE encoding of a word exactly if every two neighbouring tokens stay two tokens when BPE runs on
that pair alone: a first merge across any boundary would also happen in the pair. So the last token of the encoding of a
prefix follows from the last tokens at those earlier places where a longer token may still have begun, which are
finitely many. A state is that knowledge: the open nodes of the vocabulary trie, each with the last token before it and
how many tokens fewer the prefix had there. A transition carries the last token of the longer prefix and by how much the
number of tokens changes. States are compiled when they are first met and kept in a dense table; one that has grown
beyond `max_states` is dropped and compiled anew, so that memory is bounded. A table keeps the tokens (`with_ids`) or the
changes in number, as one is asked for.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Sequence

import numpy as np

START = 0
CHUNK = 256


class Transducer:
    """`tokens[i]`: the symbols of token i (none: text never gives it). `merge(a, b)`: (rank, token) if BPE joins these
    neighbours, None otherwise. `ends`: symbols after which no token continues, so that START follows. `restarts[s] = r`:
    s reads like r from START, whatever came before. `fixed[s] = n`: s stands alone as n tokens outside the vocabulary."""

    def __init__(
        self, tokens: Sequence[tuple[int, ...]], n_symbols: int, merge: Callable[[int, int], tuple[float, int] | None],
        ends: frozenset[int] = frozenset(), restarts: dict[int, int] | None = None, fixed: dict[int, int] | None = None,
        max_states: int = 140_000, with_ids: bool = True,
    ) -> None:
        self._with_ids = with_ids
        self._tokens, self._merge, self._ends = tokens, merge, ends
        self._restarts, self._fixed, self._max = restarts or {}, fixed or {}, max_states
        self.lengths = np.array([len(x) for x in tokens], np.int32)
        self._n_symbols = n_symbols
        self._child: dict[int, int] = {}                    # node * n_symbols + symbol -> node
        self._token = [-1]
        self._single: dict[int, int] = {}
        for i, symbols in enumerate(tokens):
            node = 0
            for s in symbols:
                following = self._child.get(node * n_symbols + s)
                if following is None:
                    following = self._child[node * n_symbols + s] = len(self._token)
                    self._token.append(-1)
                node = following
            if symbols:
                self._token[node] = i
                if len(symbols) == 1:
                    self._single[symbols[0]] = i
        self._inner = bytearray(len(self._token))           # nodes below which there are longer tokens
        for place in self._child:
            self._inner[place // n_symbols] = 1
        self._spines: dict[int, tuple | None] = {}
        self._fits: dict[int, bool] = {}                     # left << 32 | right
        self._column = np.full(n_symbols, -1, np.int32)
        self._met: list[int] = []
        self._clear(128)

    def _clear(self, width: int) -> None:
        self._width = width
        start = array("i", [-1]).tobytes()                  # last token, then (node, token before, fewer) of each open node
        self._states: list[bytes] = [start]
        self._ids = {start: START}
        rows = self._max + 20_000                           # untouched rows take no memory
        self._next = np.zeros((rows, width), np.int32)      # 0: not compiled, else the state + 1
        kind = np.uint16 if len(self._tokens) <= 0xFFFF else np.int32
        self._emit = np.zeros((rows if self._with_ids else 1, width), kind)
        self._delta = np.zeros((1 if self._with_ids else rows, width), np.int8)

    # ---- which token can follow which ----

    def _bpe(self, symbols: Sequence[int]) -> tuple[list[int], list[tuple[int, int, int, float]]]:
        """The encoding, and the merges in their order: (left, right, merged, rank)."""
        out, done = [self._single[s] for s in symbols], []
        while len(out) > 1:
            best = None
            for i in range(len(out) - 1):
                found = self._merge(out[i], out[i + 1])
                if found and (best is None or found[0] < best[0]):
                    best = (found[0], i, found[1])
            if best is None:
                break
            done.append((out[best[1]], out[best[1] + 1], best[2], best[0]))
            out[best[1]:best[1] + 2] = [best[2]]
        return out, done

    def _spine(self, token: int) -> tuple | None:
        """What stands at the left and at the right edge of the token while BPE builds it, each with the rank of the merge
        that uses it up; None if BPE doesn't build the token. In order only if ranks never fall from part to whole."""
        if token not in self._spines:
            out, done = self._bpe(self._tokens[token])
            if out != [token]:
                self._spines[token] = None
            else:
                parts = {merged: (a, b, rank) for a, b, merged, rank in done}
                in_order = all(x[3] <= y[3] for x, y in zip(done, done[1:])) and len(parts) == len(
                    {(a, b, merged) for a, b, merged, _ in done})
                edges = []
                for side in (0, 1):
                    at, until, edge = token, float("inf"), []
                    while True:
                        edge.append((at, until))
                        if at not in parts:
                            break
                        in_order &= parts[at][2] < until
                        at, until = parts[at][side], parts[at][2]
                    edges.append(edge)
                self._spines[token] = (*edges, in_order)
        return self._spines[token]

    def _fit(self, left: int, right: int) -> bool:
        """Whether right (-1: nothing before it) stays a token after left."""
        pair = (left << 32) | right
        found = self._fits.get(pair)
        if found is not None:
            return found
        b = self._spine(right)
        if left < 0:
            found = b is not None
        elif b is None or (a := self._spine(left)) is None:
            found = False
        elif a[2] and b[2]:                               # no merge across comes before both sides have moved on
            found = not any(
                (m := self._merge(x, y)) and m[0] < x_until and m[0] <= y_until for x, x_until in a[1] for y, y_until in b[0])
        else:
            found = self._bpe(self._tokens[left] + self._tokens[right])[0] == [left, right]
        if len(self._fits) > 150_000:
            self._fits.clear()
        self._fits[pair] = found
        return found

    # ---- the table ----

    def _compile(self, state: int, column: int) -> None:
        symbol, at = self._met[column], (state, column)
        if symbol in self._fixed:
            self._next[at] = START + 1
            self._label(at, 0, self._fixed[symbol])
            return
        origin = state
        if symbol in self._restarts:
            origin, symbol = START, self._restarts[symbol]
        known = array("i", self._states[origin])
        child, n = self._child, self._n_symbols
        opened, token, delta = [], -1, 0
        for i in range(1, len(known), 3):
            following = child.get(known[i] * n + symbol)
            if following is not None:
                opened.append((following, known[i + 1], known[i + 2]))
        following = child.get(symbol)
        if following is not None:
            opened.append((following, known[0], 0))
        for node, before, fewer in opened:
            t = self._token[node]
            if t >= 0 and self._fit(before, t):
                token, delta = t, fewer + 1
        if token < 0:
            raise ValueError(f"no token for symbol {symbol}")
        self._label(at, token, delta)
        if symbol in self._ends:
            self._next[at] = START + 1
            return
        key = array("i", [token])
        for node, before, fewer in opened:
            if self._inner[node]:
                key.extend((node, before, fewer - delta))
        key = key.tobytes()
        target = self._ids.get(key)
        if target is None:
            target = self._ids[key] = len(self._states)
            self._states.append(key)
            if target >= len(self._next):
                for name in ("_next", "_emit" if self._with_ids else "_delta"):
                    old = getattr(self, name)
                    setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        self._next[at] = target + 1

    def _label(self, at: tuple[int, int], token: int, delta: int) -> None:
        if self._with_ids:
            self._emit[at] = token
        else:
            self._delta[at] = delta

    def _step(self, state: np.ndarray, columns: np.ndarray, cells: np.ndarray) -> np.ndarray:
        np.multiply(state, self._width, out=cells)
        cells += columns
        found = self._next.ravel().take(cells)
        if len(found) and found.min() == 0:
            for cell in np.unique(cells[found == 0]).tolist():
                self._compile(cell // self._width, cell % self._width)
            found = self._next.ravel().take(cells)
        return found - 1

    def run(self, symbols: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The table cell of each symbol; `last` marks those after which the state is START. Chunks of equal length run side
        by side, each as if it began at START; then each chunk's exit state runs on over the head of the next chunk, up
        to the first place where the state is START anyway: from there the next chunk's map is constant. Cells hold
        until the next run."""
        if len(self._states) > self._max:
            self._clear(self._width)
        columns = self._column[symbols]
        if len(columns) and columns.min() < 0:
            self._met += np.unique(symbols[columns < 0]).tolist()
            self._column[self._met] = np.arange(len(self._met))
            if len(self._met) > self._width:
                self._clear(1 << len(self._met).bit_length())
            columns = self._column[symbols]
        n = len(columns)
        if n == 0:
            return np.empty(0, np.int32)
        lanes = -(-n // CHUNK)
        if lanes * CHUNK > n:
            columns = np.concatenate([columns, np.zeros(lanes * CHUNK - n, np.int32)])
        rows = np.ascontiguousarray(columns.reshape(lanes, CHUNK).T)
        cells = np.empty((CHUNK, lanes), np.int32)
        state = np.zeros(lanes, np.int32)
        for k in range(CHUNK):
            state = self._step(state, rows[k], cells[k])
        out = np.ascontiguousarray(cells.T).ravel()
        # exit states over the heads; the map of a chunk with no START place depends on where it is entered, so there the
        # run that began further left goes on
        stops = np.flatnonzero(last)
        begins = np.arange(1, lanes, dtype=np.int64) * CHUNK
        whole = np.concatenate([[True], last[begins - 1]])
        near = np.searchsorted(stops, begins - CHUNK)
        known = whole[:-1] | (np.append(stops, n)[near] < begins)
        go = ~whole[1:] & known
        if go.any():
            ends = np.append(stops, n - 1)[np.searchsorted(stops, begins)] + 1
            at, end, state = begins[go], ends[go], state[:-1][go]
            while len(at):
                cell = np.empty(len(at), np.int32)
                state = self._step(state, columns[at], cell)
                out[at] = cell
                at = at + 1
                keep = at < end
                at, end, state = at[keep], end[keep], state[keep]
        return out[:n]

    def tokens_at(self, cells: np.ndarray) -> np.ndarray:
        """The last token of the encoding up to each symbol."""
        return self._emit.ravel().take(cells).astype(np.int32)

    def deltas_at(self, cells: np.ndarray) -> np.ndarray:
        """By how much each symbol changes the number of tokens."""
        return self._delta.ravel().take(cells)

    def ids(self, symbols: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The token ids in order, and for each the place of its last symbol."""
        cells = self.run(symbols, last)
        stops = np.flatnonzero(last)
        begins = np.concatenate([[0], stops[:-1] + 1])
        token_of = np.full(len(cells), -1, np.int32)
        at = stops
        while len(at):                                    # back through each word, token by token
            token = self.tokens_at(cells[at])
            token_of[at] = token
            at = at - self.lengths[token]
            keep = at >= begins
            at, begins = at[keep], begins[keep]
        places = np.flatnonzero(token_of >= 0)
        return token_of[places], places
