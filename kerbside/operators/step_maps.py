"""What runs of passes do to a running mean, as maps that can be composed.

A run maps the mean before it to the mean after it. `speed` shows that this map never decreases and
that any 64 values leave very few results, whatever came before. So a run is kept as ``head``, its first
values up to ``HEAD``, and for longer runs ``ends``: what the values behind the head make of each result that the head
can have, ``low`` being the least one. Two such runs give a run of the same form, so runs form a monoid:
they may be composed in any grouping, as long as their order stays.

All functions take and give SQL texts, as steps stand inside lambda functions.
"""

from __future__ import annotations

from kerbside.functions.numbers import INT_MAX, INT_MIN, halving_mean, halving_ticks, hundredths

#: Values after which a run has few results; see `speed.TAIL`.
HEAD = 64


def _ticks(values: str, start: str) -> str:
    """Result of the values in hundredths, from a result in hundredths."""
    return f"aggregate({values}, cast({start} as int), (ticks, v) -> {halving_ticks(hundredths('ticks'), 'v')})"


def _from(values: str, position: int) -> str:
    return f"slice({values}, {position}, size({values}))"


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _run(head: str, low: str = "cast(null as int)", ends: str = "cast(null as array<int>)") -> str:
    return f"struct({head} as head, {low} as low, {ends} as ends)"


def _long(values: str, then: str) -> str:
    """The run of more than ``HEAD`` values; ``then`` turns the result ``r`` after all of them to the run's result."""
    low, high = (_ticks("slice(s.head, 3, size(s.head))", str(bound)) for bound in (INT_MIN, INT_MAX))
    ends = f"transform(sequence(g.low, g.high), t -> {_let('r', _ticks('s.rest', 't'), then)})"
    spread = _let("g", f"struct({low} as low, {high} as high)", _run("s.head", "g.low", ends))
    return _let("s", f"struct(slice({values}, 1, {HEAD}) as head, {_from(values, HEAD + 1)} as rest)", spread)


def run_of(values: str) -> str:
    """The run of an ordered array of at least one value."""
    return f"if(size({values}) <= {HEAD}, {_run(values)}, {_long(values, 'r')})"


def _ticks_after(run: str, mean: str) -> str:
    """Result of a run in hundredths, from a mean."""
    behind = _ticks(_from(f"{run}.head", 2), halving_ticks(mean, f"{run}.head[0]"))
    return f"if({run}.ends is null, {behind}, {run}.ends[{behind} - {run}.low])"


def composed(a: str, b: str) -> str:
    """The run of ``a`` followed by ``b``."""
    after = _run(f"{a}.head", f"{a}.low", f"transform({a}.ends, e -> {_ticks_after(b, hundredths('e'))})")
    longer = _long("w", f"if({b}.ends is null, r, {b}.ends[r - {b}.low])")
    joined = _let("w", f"concat({a}.head, {b}.head)", f"if(size(w) <= {HEAD}, {_run('w')}, {longer})")
    return f"if({a}.ends is not null, {after}, {joined})"


def composed_all(runs: str) -> str:
    """The run of an ordered array of at least one run."""
    return f"aggregate({_from(runs, 2)}, {runs}[0], (a, b) -> {composed('a', 'b')})"


def mean_of(run: str) -> str:
    """The mean after a run that no mean comes before."""
    few = f"aggregate({_from(f'{run}.head', 2)}, {run}.head[0], (mean, v) -> {halving_mean('mean', 'v')})"
    behind = _ticks(_from(f"{run}.head", 3), halving_ticks(f"{run}.head[0]", f"{run}.head[1]"))
    return f"if({run}.ends is null, {few}, {hundredths(f'{run}.ends[{behind} - {run}.low]')})"
