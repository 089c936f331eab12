"""A weighted backoff automaton of n-gram counts, walked from left to right.

States are the histories seen in training, the empty one (state 0) and the marks before a text.
From history h an arc for word w, if hw was seen, leads to the state of the longest seen suffix of
hw with log10((c(hw) + k P(w)) / (c(h) + k)), where P is the chance after the shorter history. Else
the failure arc, log10(k / (c(h) + k)), leads to the state of the shorter history, down to the empty
one, which has an arc for every word: (c(w) + 1) / (N + V + 1).

An automaton is built for the n-grams of some texts from their counts in all training text; a walk
over these texts meets no others, so it is the walk through the automaton of the whole corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Automaton:
    """Arcs by state and word, and a failure arc for each state. Arc w leaves the empty state for word w."""

    start: int
    words: int
    arcs: dict[int, int]
    to: list[int]
    weight: list[float]
    fails_to: list[int]
    fail_weight: list[float]

    def walk(self, words: list[int], state: int) -> tuple[float, int]:
        """Log probability of the words from a state on, and the state after them."""
        find, to, weight, width = self.arcs.get, self.to, self.weight, self.words
        fails_to, fail_weight = self.fails_to, self.fail_weight
        total = 0.0
        for word in words:
            while state:
                arc = find(state * width + word)
                if arc is not None:
                    break
                total += fail_weight[state]
                state = fails_to[state]
            else:
                arc = word
            total += weight[arc]
            state = to[arc]
        return total, state


def automaton(
    at: list[np.ndarray], seen: list[np.ndarray], place: np.ndarray, texts: int, strength: float,
    all_tokens: int, all_known: int,
) -> Automaton:
    """The automaton of the n-grams of some tokens. `at[j][p]` numbers the (j+1)-gram that ends at
    token p, marks before the text included, `seen[j]` holds the training counts by that number,
    `place` the tokens' places in their texts and `texts` how many training texts there are."""
    order = len(at)
    some = []
    for own, counts in zip(at, seen, strict=True):
        places = np.empty(len(counts), np.int64)
        places[own] = np.arange(len(own))
        some.append(places)
    # Numbers of the first state of each length; the marks alone come last, one state per length.
    base = 1 + np.concatenate([[0], np.cumsum([len(counts) for counts in seen[:-1]], dtype=np.int64)])
    marks = int(base[-1])
    fails_to = np.zeros(marks + order - 1, np.int64)
    counted = np.zeros(len(fails_to))
    for j in range(order - 1):
        own = slice(base[j], base[j + 1])
        counted[own] = seen[j]
        if j:
            fails_to[own] = base[j - 1] + at[j - 1][some[j]]
            fails_to[marks + j] = marks + j - 1
    counted[marks:] = texts

    chance = (seen[0] + 1) / (all_tokens + all_known + 1)
    weights = [np.log10(chance)]
    to = [np.where(seen[0] > 0, base[0] + np.arange(len(seen[0])), 0) if order > 1 else np.zeros(len(seen[0]), np.int64)]
    keys = []
    for j in range(1, order):
        p = some[j]
        history = np.where(place[p] == 0, marks + j - 1, base[j - 1] + at[j - 1][p - 1])
        chance = (seen[j] + strength * chance[at[j - 1][p]]) / (counted[history] + strength)
        is_arc = np.flatnonzero(seen[j] > 0)
        keys.append((history * len(seen[0]) + at[0][p])[is_arc])
        weights.append(np.log10(chance[is_arc]))
        longest = base[j] + np.arange(len(p)) if j < order - 1 else base[j - 1] + at[j - 1][p]
        to.append(longest[is_arc])
    every = np.concatenate(keys).tolist() if keys else []
    return Automaton(
        start=marks + order - 2 if order > 1 and texts else 0, words=len(seen[0]),
        arcs=dict(zip(every, range(len(seen[0]), len(seen[0]) + len(every)), strict=True)),
        to=np.concatenate(to).tolist(), weight=np.concatenate(weights).tolist(),
        fails_to=fails_to.tolist(), fail_weight=np.log10(strength / (counted + strength)).tolist(),
    )
