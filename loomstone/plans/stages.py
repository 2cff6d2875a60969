"""Stages, what each may and must be told, and a runner that goes on after failures."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from pathlib import Path

# Flags, stages and channels.
VERSION, UNIVERSE, FULL, SAMPLE, BATCH, PLATFORM, CHANNEL = "version", "universe", "full", "sample", "batch", "platform", "channel"
CHANNELS = {"git": ("commits",), "github": ("issues", "prs", "pr_reviews", "comments")}
EXCLUSIVE = ((VERSION, UNIVERSE), (VERSION, SAMPLE), (UNIVERSE, FULL))
DEFAULT_BATCH = 50


@dataclass(frozen=True)
class Stage:
    name: str
    about: str
    allows: frozenset[str] = frozenset()
    requires: frozenset[str] = frozenset()
    walks: bool = False
    walks_on: str | None = None


_WALK = frozenset({VERSION, UNIVERSE, FULL, BATCH})
STAGES = {
    s.name: s
    for s in (
        Stage("meta", "commit lineage; defines the universe that all others join on", frozenset({VERSION})),
        Stage("ledger", "files that each commit changed", _WALK, walks=True),
        Stage("refm", "refactorings of each commit", _WALK, walks=True),
        Stage("diff", "message and changed lines of each commit", _WALK, walks=True),
        Stage("ck", "structural metrics of each snapshot", frozenset({VERSION, SAMPLE, BATCH})),
        Stage("channel", "commits, issues, pull requests, reviews, comments", _WALK | {PLATFORM, CHANNEL}, frozenset({PLATFORM, CHANNEL}), walks_on="git"),
        Stage("link", "discourse tied to commits; replaces its output"),
        Stage("report", "what has been mined so far"),
    )
}


class PlanError(ValueError):
    """All that is wrong with a plan."""

    def __init__(self, faults: list[str]):
        super().__init__("\n".join(faults))
        self.faults = faults


@dataclass(frozen=True)
class RunPlan:
    repo: str
    stage: str
    version: str | None = None
    universe: str | None = None
    full: bool = False
    sample: str | None = None
    platform: str | None = None
    channels: str | None = None
    batch: int | None = None  # None: not given, which differs from the default's value
    paths: dict[str, Path] = field(default_factory=dict)

    @property
    def given(self) -> frozenset[str]:
        values = {VERSION: self.version, UNIVERSE: self.universe, FULL: self.full or None, SAMPLE: self.sample, BATCH: self.batch, PLATFORM: self.platform, CHANNEL: self.channels}
        return frozenset(k for k, v in values.items() if v is not None)

    @property
    def walks(self) -> bool:
        spec = STAGES[self.stage]
        return spec.walks or (spec.walks_on is not None and spec.walks_on == (self.platform or "").lower())

    @property
    def limit(self) -> int:
        """Units of a run; zero or less is all."""
        return DEFAULT_BATCH if self.batch is None else self.batch

    @property
    def known_channels(self) -> tuple[str, ...]:
        return CHANNELS.get((self.platform or "").lower(), ())

    @property
    def wanted_channels(self) -> tuple[str, ...]:
        """As listed; "all" stands for all only when alone."""
        asked = tuple(c.strip().lower() for c in (self.channels or "").split(",") if c.strip())
        return self.known_channels if asked == ("all",) else asked

    @property
    def scope(self) -> str:
        """What a walking stage covers. A version alone stands for a scope and covers everything; see single_point."""
        return "explicit" if self.universe else "full"


def described(plan: RunPlan) -> list[str]:
    """What a run is about to do, as lines for a console."""
    spec = STAGES[plan.stage]
    return [
        f"repository: {plan.repo}", f"stage: {plan.stage}",
        *([f"scope: {plan.scope}{f' ({plan.universe})' if plan.universe else ''}"] if plan.walks or plan.version else []),
        *([f"sample: {plan.sample}"] if plan.sample else []),
        *([f"channels: {plan.platform} -> {', '.join(plan.wanted_channels)}"] if CHANNEL in spec.allows else []),
        *([f"batch: {plan.limit if plan.limit > 0 else 'unlimited'}"] if BATCH in spec.allows else []),
    ]


def stages_allowing(flag: str) -> list[str]:
    return [s.name for s in STAGES.values() if flag in s.allows]


def validate(plan: RunPlan, folder: Path | None = None) -> RunPlan:
    """The plan with its files resolved, or PlanError with every fault; files are looked for only if the flags are right."""
    if plan.stage not in STAGES:
        raise PlanError([f"unknown stage {plan.stage!r}; there are {', '.join(STAGES)}"])
    spec, given = STAGES[plan.stage], plan.given
    faults = [f"--{f} is not for stage {plan.stage}; it is for {', '.join(stages_allowing(f)) or 'none'}" for f in sorted(given - spec.allows)]
    faults += [f"stage {plan.stage} needs --{f}" for f in sorted(spec.requires - given)]
    faults += [f"--{a} and --{b} exclude each other" for a, b in EXCLUSIVE if a in given and b in given]
    if plan.walks and not given & {UNIVERSE, FULL, VERSION}:
        faults.append(f"stage {plan.stage} walks commits; say which, by --universe or --full")
    elif FULL in given and FULL in spec.allows and not plan.walks:
        faults.append("--full is for what walks commits")
    if plan.platform is not None and PLATFORM in spec.allows:
        if not plan.known_channels:
            faults.append(f"unknown platform {plan.platform!r}; there are {', '.join(CHANNELS)}")
        else:
            unknown = [c for c in plan.wanted_channels if c not in plan.known_channels]
            faults += [f"unknown channel {c!r} of {plan.platform}; there are {', '.join(plan.known_channels)}" for c in unknown]
    paths: dict[str, Path] = {}
    if not faults:
        for flag, name in ((UNIVERSE, plan.universe), (SAMPLE, plan.sample)):
            if name is not None:
                tried = [p for p in (Path(name), (folder or Path()) / name) if p.is_file()]
                if tried:
                    paths[flag] = tried[0]
                else:
                    faults.append(f"--{flag}: no such file: {name}")
    if faults:
        raise PlanError(faults)
    return replace(plan, paths=paths)


@dataclass(frozen=True)
class Command:
    name: str
    run: Callable[[], bool]
    needs_health: bool = False


def run_all(commands: Iterable[Command]) -> tuple[int, dict[str, bool]]:
    """Exit code and results. A failure does not stop the rest, but what summarises others is then skipped."""
    results: dict[str, bool] = {}
    for c in commands:
        results[c.name] = False if c.needs_health and not all(results.values()) else bool(c.run())
    return int(not all(results.values())), results


def chained(strategies: dict[str, Callable], names: Iterable[str], warn: Callable[[str], None] = print) -> Callable:
    """One function over a table that applies the named strategies in order; unknown or unset ones are told and skipped."""
    chosen = []
    for n in names:
        if strategies.get(n) is None:
            warn(f"no strategy {n}")
        else:
            chosen.append(strategies[n])
    if not chosen:
        raise ValueError("no strategy to apply")

    def apply(df):
        for f in chosen:
            df = f(df)
        return df

    return apply
