"""Which pairs of a ranking can be merged together."""

from __future__ import annotations


def choose_merges(top: list[tuple[int, int, int]], complete: bool, min_frequency: int,
                  room: int) -> list[tuple[int, int]]:
    """Merges that one pair count decides exactly, in creation order.

    ``top`` is the best pairs ``(count, left, right)`` in (count desc, left,
    right) order; ``complete`` says that no pair outside it need be feared (in
    a list cut out of the full ranking, none need: see below).  The first pair
    is the next merge.  The merges of a round are a leading run of the ranking
    in which no symbol is left in one pair and right in another:

    * such pairs never overlap in a word, so merging one leaves the counts of
      the others as they are;
    * a pair ``(z, new)`` or ``(new, z)`` that merging ``(a, b)`` creates has at
      most the count of ``(z, a)`` or ``(b, z)``.  Those would end the run, so
      they rank behind all of it, in ``top`` or outside; and at equal counts
      the new pair does too, as ids of new symbols are the highest.

    A pair of one symbol with itself creates pairs that only its own count
    bounds, so it is the only merge of its round.  If ``complete`` is false,
    pairs with the last listed count are not merged behind others.
    """
    chosen: list[tuple[int, int]] = []
    lefts: set[int] = set()
    rights: set[int] = set()
    tail = -1 if complete or not top else top[-1][0]
    for n, a, b in top:
        if len(chosen) >= room or n < min_frequency:
            break
        if a in rights or b in lefts or chosen and (a == b or n <= tail):
            break
        chosen.append((a, b))
        lefts.add(a)
        rights.add(b)
        if a == b:
            break
    return chosen
