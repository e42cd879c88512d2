"""Suffix automata over words, and matching statistics against them."""

from collections.abc import Sequence


class SuffixAutomaton:
    """Recognises every run of words of the texts added so far."""

    def __init__(self):
        self.moves: list[dict] = [{}]
        self.links = [-1]
        self.lengths = [0]

    def add(self, words: Sequence) -> None:
        """Add a text; runs across two texts are not recognised."""
        last = 0
        for word in words:
            last = self._extend(last, word)

    def _extend(self, last: int, word) -> int:
        moves, links, lengths = self.moves, self.links, self.lengths
        known = moves[last].get(word)
        if known is not None:
            if lengths[known] == lengths[last] + 1:
                return known
            return self._clone(last, word, known)
        state = len(moves)
        moves.append({})
        links.append(0)
        lengths.append(lengths[last] + 1)
        at = last
        while at >= 0 and word not in moves[at]:
            moves[at][word] = state
            at = links[at]
        if at >= 0:
            known = moves[at][word]
            links[state] = known if lengths[known] == lengths[at] + 1 else self._clone(at, word, known)
        return state

    def _clone(self, at: int, word, state: int) -> int:
        """A copy of ``state`` for the shorter runs that end like those of ``at``, then word."""
        moves, links, lengths = self.moves, self.links, self.lengths
        copy = len(moves)
        moves.append(dict(moves[state]))
        links.append(links[state])
        lengths.append(lengths[at] + 1)
        links[state] = copy
        while at >= 0 and moves[at].get(word) == state:
            moves[at][word] = copy
            at = links[at]
        return copy

    def matches(self, words: Sequence) -> list[int]:
        """For each word, how many words up to it stand together in some added text."""
        moves, links, lengths = self.moves, self.links, self.lengths
        state = length = 0
        found = []
        for word in words:
            while state and word not in moves[state]:
                state = links[state]
                length = lengths[state]
            step = moves[state].get(word)
            if step is not None:
                state, length = step, length + 1
            found.append(length)
        return found
