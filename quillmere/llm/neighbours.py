"""Whether two neighbouring BPE entries stay apart, without merging their symbols.

An entry that is merged alone grows, at its two ends, through a series of symbols, each formed at the rank of one rule. Side by
side, the last symbol of the left entry and the first of the right one are neighbours for a while; the entries stay apart if at no time
there is a rule for these two that comes before the rule that next changes either. Of equal ranks the leftmost goes first: a
change of the left entry before the rule across, and that before a change of the right one.
"""

from __future__ import annotations

from collections.abc import Callable

NEVER = 1 << 60


def ends(symbols: list, rank: Callable) -> tuple[tuple, tuple] | None:
    """(first symbols, last symbols) of an entry as it is merged from its symbols, each as (symbol, rank it ends at);
    None if merging doesn't make one entry of them. rank(a, b) is a rule's rank, or None."""
    parts = list(symbols)
    first, last = [(parts[0], -1)], [(parts[-1], -1)]  # with the rank that each is formed at, when the one before it ends
    ranks = [r if (r := rank(a, b)) is not None else NEVER for a, b in zip(parts, parts[1:])]
    while ranks:
        best = min(ranks)
        if best == NEVER:
            return None
        at = ranks.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del ranks[at]
        for i in (at - 1, at):
            if 0 <= i < len(ranks):
                ranks[i] = r if (r := rank(parts[i], parts[i + 1])) is not None else NEVER
        if at == 0:
            first.append((parts[0], best))
        if at == len(parts) - 1:
            last.append((parts[-1], best))
    span = lambda x: tuple((s, e) for (s, _), (_, e) in zip(x, [*x[1:], (None, NEVER)]))
    return span(first), span(last)


def apart(last: tuple, first: tuple, rank: Callable) -> bool:
    """Whether an entry with these last symbols and one with these first symbols stay as they are side by side."""
    i = j = 0
    while True:
        x, x_ends = last[i]
        y, y_ends = first[j]
        r = rank(x, y)
        if r is not None and r < x_ends and r <= y_ends:
            return False
        if x_ends == y_ends == NEVER:
            return True
        if x_ends <= y_ends:
            i += 1
        else:
            j += 1
