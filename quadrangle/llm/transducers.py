"""Small weighted transducers over clause symbols, and their composition.

A machine reads one symbol at a time and writes one. Clauses are read as the symbols
`I` insult, `H` threat, `T` target, `N` negation, `R` reporting verb, `w` any other word,
and `#` for the end.
"""

WORD, INSULT, THREAT, TARGET, NEGATION, REPORT, END = "w", "I", "H", "T", "N", "R", "#"
INPUT = (WORD, INSULT, THREAT, TARGET, NEGATION, REPORT, END)
NEGATION_REACH = 3


class Transducer:
    """Deterministic machine: `arcs[state, symbol] = (next state, written symbol)`."""

    def __init__(self, start, arcs):
        self.start, self.arcs = start, arcs

    def read(self, symbols):
        state, out = self.start, []
        for symbol in symbols:
            state, written = self.arcs[state, symbol]
            out.append(written)
        return out


def compose(first, second, alphabet=INPUT):
    """The machine that feeds what `first` writes to `second`, over reachable states."""
    start = (first.start, second.start)
    arcs, waiting, seen = {}, [start], {start}
    while waiting:
        state = waiting.pop()
        for symbol in alphabet:
            left, middle = first.arcs[state[0], symbol]
            right, written = second.arcs[state[1], middle]
            arcs[state, symbol] = ((left, right), written)
            if (left, right) not in seen:
                seen.add((left, right))
                waiting.append((left, right))
    return Transducer(start, arcs)


def _negation():
    """Insults and threats within a few words after a negation are marked `-`."""
    arcs = {}
    for left in range(NEGATION_REACH + 1):
        for symbol in INPUT:
            after = NEGATION_REACH if symbol == NEGATION else max(0, left - 1)
            written = symbol + "-" if left and symbol in (INSULT, THREAT) else symbol
            arcs[left, symbol] = (after, written)
    return Transducer(0, arcs)


def _report():
    """Insults and threats after a reporting verb are marked `"`; a negated one stays negated."""
    arcs = {}
    symbols = (*INPUT, INSULT + "-", THREAT + "-")
    for told in (False, True):
        for symbol in symbols:
            written = symbol + '"' if told and symbol in (INSULT, THREAT) else symbol
            arcs[told, symbol] = (told or symbol == REPORT, written)
    return Transducer(False, arcs)


KINDS = ("plain insult", "targeted insult", "negated insult", "reported insult", "threat")


def _verdict():
    """Remembers what a clause holds; at its end writes the kinds found, as a frozenset."""
    marks = {INSULT: "i", INSULT + "-": "n", INSULT + '"': "r", THREAT: "h", TARGET: "t"}
    symbols = (*INPUT, INSULT + "-", INSULT + '"', THREAT + "-", THREAT + '"')
    arcs = {}
    held = [frozenset(x for bit, x in enumerate("inrht") if number >> bit & 1) for number in range(32)]
    for state in held:
        for symbol in symbols:
            if symbol == END:
                kinds = set()
                if "i" in state:
                    kinds.add(KINDS[1] if "t" in state else KINDS[0])
                if "n" in state:
                    kinds.add(KINDS[2])
                if "r" in state:
                    kinds.add(KINDS[3])
                if "h" in state and "t" in state:
                    kinds.add(KINDS[4])
                arcs[state, symbol] = (frozenset(), frozenset(kinds))
            else:
                mark = marks.get(symbol)
                arcs[state, symbol] = (state | {mark} if mark else state, "")
    return Transducer(frozenset(), arcs)


GRAMMAR = compose(compose(_negation(), _report()), _verdict())


def clause_kinds(symbols):
    """Kinds of the pattern found in one clause."""
    return GRAMMAR.read([*symbols, END])[-1]
