"""Double arrays: tries whose children are found by one look-up in an array.

The child of a state by a code stands at ``base[state] ^ code``; it is one if ``check``
there names the state. The root is state 0, a free place has ``check`` -1.
"""

from __future__ import annotations

import numpy as np


def _placed(parent: np.ndarray, code: np.ndarray, nodes: int, dense: bool) -> np.ndarray:
    """A base for each node under which no two children of the trie meet: all nodes
    try a place at once, those with more children go first, the rest try again.
    ``dense``: about two places an edge, and only the few edges that are left get more."""
    degree = np.bincount(parent, minlength=nodes)
    base = np.zeros(nodes, np.int64)
    order = np.lexsort((parent, -degree[parent]))  # edges, by node, of many children first
    parent, code = parent[order], code[order]
    free = 1 << max(8, (2 * len(parent)).bit_length(), int(code.max()).bit_length())
    block = 1 << max(8, int(code.max()).bit_length())
    if dense:
        free = block * -(-2 * nodes // block)
    used = np.zeros(free, bool)
    used[0] = True  # the root
    rng, turns, low = np.random.default_rng(1), 0, 0
    taker = np.empty(len(used), np.int32)  # the first edge that tried a place
    while len(parent):
        first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        count = np.diff(np.append(first, len(parent)))
        tried = rng.integers(low, len(used), len(first))
        place = np.repeat(tried, count) ^ code
        edges = np.arange(len(place), dtype=np.int32)
        taker[place[::-1]] = edges[::-1]
        clear = taker[place] == edges
        ok = np.logical_and.reduceat(clear & ~used[place], first)
        base[parent[first[ok]]] = tried[ok]
        done = np.repeat(ok, count)
        used[place[done]] = True
        parent, code = parent[~done], code[~done]
        turns += 1
        if turns % 16 == 0:  # crowded: the others go to fresh places
            low = len(used)
            used = np.concatenate([used, np.zeros(block * -(-4 * len(parent) // block) if dense else len(used), bool)])
            taker = np.empty(len(used), np.int32)
    return base


def double_array(parent: np.ndarray, code: np.ndarray, dense: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check, and the state of each node. The k-th edge leads to node k + 1; node 0
    is the root. ``dense``: in less memory."""
    nodes = len(parent) + 1
    own = _placed(parent, code, nodes, dense)
    state = np.zeros(nodes, np.int64)
    state[1:] = own[parent] ^ code
    size = (int(state.max()) | ((1 << max(8, int(code.max()).bit_length())) - 1)) + 1  # whole blocks of codes
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    base[state] = own
    check[state[1:]] = state[parent]
    return base, check, state
