"""Quality checks as plain functions that report line by line.

A check is a generator function. It takes a ``Context`` and keyword-only options with defaults, and yields what it
finds: ``Figure`` (a number with a name), ``Problem`` (a warning or a failure) and ``Sample`` (a row that shows a
problem). Its options, their types and defaults are those of its signature, its help is its docstring; the command
line is made from them.

    @check("source")
    def no_gaps(context: Context, *, least: Annotated[int, "smallest number of rows"] = 1):
        yield Figure("rows", ...)
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import Annotated, Any, NamedTuple, get_args, get_origin, get_type_hints

from pyspark.sql import DataFrame, SparkSession

#: What a check can say, from best to worst; what it can look at.
LEVELS = ("pass", "warning", "fail")
SUBJECTS = ("source", "output")


@dataclass(frozen=True)
class Context:
    """Where a check finds its data: a session, the data set's folder, and how one day is read from it."""

    spark: SparkSession
    root: Path
    day_reader: Callable[[SparkSession, Path, int], tuple[DataFrame, DataFrame]]

    def day(self, date: int) -> tuple[DataFrame, DataFrame]:
        """Minute bars and daily rows of one day."""
        return self.day_reader(self.spark, self.root, date)


class Figure(NamedTuple):
    name: str
    value: Any


class Problem(NamedTuple):
    level: str
    kind: str
    text: str


class Sample(NamedTuple):
    text: str


class Parameter(NamedTuple):
    name: str
    type: Callable[[str], Any]
    default: Any
    help: str


_known: dict[str, tuple[str, Callable[..., Iterator]]] = {}


def check(subject: str) -> Callable[[Callable[..., Iterator]], Callable[..., Iterator]]:
    """Make a function known under its name, with dashes."""
    if subject not in SUBJECTS:
        raise ValueError(f"a check looks at one of {SUBJECTS}, not at {subject}")

    def add(function: Callable[..., Iterator]) -> Callable[..., Iterator]:
        name = function.__name__.replace("_", "-")
        if name in _known:
            raise ValueError(f"there is a check {name} already")
        _known[name] = subject, function
        return function

    return add


def names() -> list[str]:
    return sorted(_known)


def _find(name: str) -> tuple[str, Callable[..., Iterator]]:
    try:
        return _known[name]
    except KeyError:
        raise KeyError(f"{name} is no check; checks are {', '.join(names()) or 'none'}") from None


def subject(name: str) -> str:
    return _find(name)[0]


def about(name: str) -> str:
    return (inspect.getdoc(_find(name)[1]) or "").partition("\n")[0]


def parameters(name: str) -> list[Parameter]:
    """The options of a check, from its signature."""
    function = _find(name)[1]
    hints = get_type_hints(function, include_extras=True)
    out = []
    for p in inspect.signature(function).parameters.values():
        if p.kind is p.KEYWORD_ONLY:
            hint = hints.get(p.name, str)
            plain, text = get_args(hint)[:2] if get_origin(hint) is Annotated else (hint, "")
            out.append(Parameter(p.name, plain, p.default, text))
    return out


class Outcome:
    """What a check found, and its report."""

    def __init__(self, name: str, found: Iterable[Figure | Problem | Sample]):
        self.name, self.found = name, list(found)

    @property
    def figures(self) -> dict[str, Any]:
        return {f.name: f.value for f in self.found if isinstance(f, Figure)}

    @property
    def problems(self) -> list[Problem]:
        return [f for f in self.found if isinstance(f, Problem)]

    @property
    def samples(self) -> list[str]:
        return [f.text for f in self.found if isinstance(f, Sample)]

    @property
    def level(self) -> str:
        return LEVELS[max((LEVELS.index(p.level) for p in self.problems), default=0)]

    def __str__(self) -> str:
        out = [f"== {self.name} [{subject(self.name)}] {self.level.upper()} =="]
        shown = {n: shape(v) for n, v in self.figures.items()}
        right = max(map(len, shown.values()), default=0)
        out += [f"{v:>{right}}  {n.replace('_', ' ')}" for n, v in shown.items()]
        out += [f"! {p.level}: {p.text} ({p.kind})" for p in self.problems]
        return "\n".join([*out, *(f"  - {s}" for s in self.samples)])


def shape(value: Any) -> str:
    """Whole numbers with separators, others with six digits, anything else as it prints."""
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return str(value)
    return format(value, "," if isinstance(value, int) else ".6g")


def run(name: str, context: Context, **options: Any) -> Outcome:
    """Run one check. An option that it does not have is a KeyError."""
    unknown = options.keys() - {p.name for p in parameters(name)}
    if unknown:
        raise KeyError(f"{name} takes no {', '.join(sorted(unknown))}")
    return Outcome(name, _find(name)[1](context, **options))


def run_all(context: Context, wanted: dict[str, dict[str, Any]]) -> list[Outcome]:
    """Run several checks, each with its options, in the given order."""
    return [run(name, context, **options) for name, options in wanted.items()]
