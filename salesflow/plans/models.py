"""Models that read one another: built in the order of their references, tested, and published only when clean.

A model is SQL text that names what it reads by ``{{ ref('model') }}`` and ``{{ source('group', 'table') }}``, or a function of
the DataFrames it declares to read. A build runs the models in dependency order. Each result is written as a new
version of its layer (``sources.versions``), its contract is tested on what was written, and only a clean version is
published: readers keep the last good one of a model that fails. What depends on a failed model, directly or not, is
skipped; everything else is built.

``load_project`` reads a folder of such models: ``*.sql`` files, and ``*.yml`` files with descriptions, column tests and sources.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from graphlib import CycleError, TopologicalSorter
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..operators.layers import with_comments
from ..operators.quality import dq_report
from ..schemas import ColumnContract, ModelContract
from ..session import unique_name
from ..sources.versions import read_layer, stage

TESTS = ("not_null", "unique")
_TAG = re.compile(r"\{\{(.*?)\}\}", re.S)


class ModelError(ValueError):
    """A model graph that can't be built: a cycle, an unknown name, text that isn't understood."""


@dataclass(frozen=True)
class Model:
    """One model: ``sql`` text, or ``build``, a function that takes the SparkSession and the DataFrames of ``reads`` in order
    (model names, or ``group.table`` for sources). A ``view`` is not written: its readers compute it."""
    name: str
    sql: str | None = None
    build: Callable[..., DataFrame] | None = None
    reads: tuple[str, ...] = ()
    contract: ModelContract | None = None
    materialized: str = "table"
    partition_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if (self.sql is None) == (self.build is None):
            raise ModelError(f"model {self.name}: either sql or build")
        if self.materialized not in ("table", "view"):
            raise ModelError(f"model {self.name}: materialized is table or view, not {self.materialized!r}")


@dataclass(frozen=True)
class Outcome:
    """What became of a model: built, failed (a test), error (it could not run) or skipped (something it reads was not built)."""
    model: str
    status: str
    failures: int = 0
    detail: str = ""


# ---- references -------------------------------------------------------------------------------------


def _call(text: str, where: str) -> tuple[str, list, dict]:
    """(function, arguments, keywords) of the text between braces: literals only."""
    try:
        call = ast.parse(text.strip(), mode="eval").body
        if not isinstance(call, ast.Call) or not isinstance(call.func, ast.Name):
            raise ValueError
        return call.func.id, [ast.literal_eval(a) for a in call.args], {k.arg: ast.literal_eval(k.value) for k in call.keywords}
    except (SyntaxError, ValueError):
        raise ModelError(f"{where}: {{{{ {text.strip()} }}}} is not a ref, source or config") from None


def _replaced(sql: str, where: str, named: Callable[[str], str]) -> tuple[str, dict]:
    """(SQL with each reference replaced by ``named(reference)``, the text's config)."""
    config: dict = {}

    def one(tag: re.Match) -> str:
        function, args, words = _call(tag[1], where)
        if function == "config" and not args:
            config.update(words)
            return ""
        if not words and (function, len(args)) in (("ref", 1), ("source", 2)) and all(isinstance(a, str) for a in args):
            return named(".".join(args))
        raise ModelError(f"{where}: {{{{ {tag[1].strip()} }}}} is not a ref, source or config")

    return _TAG.sub(one, sql), config


def references(model: Model) -> list[str]:
    """What a model reads, each once, in the order of the text."""
    if model.sql is None:
        return list(dict.fromkeys(model.reads))
    found: list[str] = []
    _replaced(model.sql, f"model {model.name}", lambda r: found.append(r) or r)
    return list(dict.fromkeys(found))


def build_order(models: Iterable[Model], sources: Iterable[str] = ()) -> list[Model]:
    """The models so that each comes after all it reads. Cycles, repeated and unknown names raise."""
    by_name: dict[str, Model] = {}
    for m in models:
        if m.name in by_name:
            raise ModelError(f"two models are called {m.name}")
        by_name[m.name] = m
    known = set(sources)
    graph = {}
    for m in by_name.values():
        reads = references(m)
        unknown = [r for r in reads if r not in by_name and r not in known]
        if unknown:
            raise ModelError(f"model {m.name} reads unknown {', '.join(unknown)}")
        graph[m.name] = [r for r in reads if r in by_name]
    try:
        return [by_name[n] for n in TopologicalSorter(graph).static_order()]
    except CycleError as e:
        raise ModelError(f"models read one another in a circle: {' -> '.join(reversed(e.args[1]))}") from None


# ---- builds -----------------------------------------------------------------------------------------


def _config(model: Model) -> Model:
    """The model with what its own text configures."""
    if model.sql is None:
        return model
    _, config = _replaced(model.sql, f"model {model.name}", lambda r: r)
    by = config.get("partition_by", model.partition_by)
    return replace(model, materialized=config.get("materialized", model.materialized),
                   partition_by=(by,) if isinstance(by, str) else tuple(by))


def _frame(spark: SparkSession, model: Model, known: Mapping[str, DataFrame]) -> DataFrame:
    reads = references(model)
    if model.build is not None:
        return model.build(spark, *[known[r] for r in reads])
    views = {r: unique_name("salesflow_model") for r in reads}
    try:
        for r, view in views.items():
            known[r].createOrReplaceTempView(view)
        return spark.sql(_replaced(model.sql, f"model {model.name}", lambda r: f"`{views[r]}`")[0])
    finally:  # the plan holds what the views stood for
        for view in views.values():
            spark.catalog.dropTempView(view)


def _source(spark: SparkSession, at: DataFrame | str) -> DataFrame:
    """A DataFrame, a path to Parquet files, or the name of a catalog table."""
    if isinstance(at, DataFrame):
        return at
    return spark.read.parquet(at) if "/" in at else spark.table(at)


def layer_root(root: str, model: str) -> str:
    return f"{root.rstrip('/')}/{model}"


def build_models(spark: SparkSession, models: Sequence[Model], sources: Mapping[str, DataFrame | str], root: str,
                 select: Sequence[str] | None = None) -> list[Outcome]:
    """Build the models under ``root``, each tested before it is published. ``select`` builds these models and all they
    read only. A model that fails its tests or can't run takes its descendants out of this build and nothing else."""
    order = [_config(m) for m in build_order(models, sources)]
    if select is not None:
        unknown = set(select) - {m.name for m in order}
        if unknown:
            raise ModelError(f"no model is called {', '.join(sorted(unknown))}")
        wanted = set(select)
        for m in reversed(order):
            if m.name in wanted:
                wanted.update(references(m))
        order = [m for m in order if m.name in wanted]
    known: dict[str, DataFrame] = {}
    for name in {r for m in order for r in references(m)} & set(sources):
        known[name] = _source(spark, sources[name])
    out: list[Outcome] = []
    for m in order:
        missing = [r for r in references(m) if r not in known]
        if missing:
            out.append(Outcome(m.name, "skipped", detail=f"reads {', '.join(missing)}"))
            continue
        try:
            out.append(_build(spark, m, known, root))
        except Exception as e:  # this model's own: its plan, its data or its write
            out.append(Outcome(m.name, "error", detail=str(e).split("\n")[0][:500]))
    return out


def _build(spark: SparkSession, m: Model, known: dict[str, DataFrame], root: str) -> Outcome:
    df = _frame(spark, m, known)
    if m.contract is not None:
        lacking = [c.name for c in m.contract.columns if c.name not in df.columns]
        if lacking:
            return Outcome(m.name, "failed", len(lacking), f"no column {', '.join(lacking)}")
        df = with_comments(df, m.contract)
    staged = None if m.materialized == "view" else stage(df, layer_root(root, m.name), m.partition_by)
    written = df if staged is None else staged.read()
    if m.contract is not None and any(c.tests for c in m.contract.columns):
        # one row for each declared test
        bad = [r for r in dq_report(written, m.contract).collect() if r["failures"]]
        if bad:
            told = "; ".join(f"{r['column_name']} {r['test']}: {r['failures']}" for r in sorted(bad))
            return Outcome(m.name, "failed", sum(r["failures"] for r in bad), told)
    if staged is not None:
        staged.publish()
    known[m.name] = written
    return Outcome(m.name, "built")


def build_report(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    """(model, status, failures, detail), a row for each model."""
    return spark.createDataFrame([(o.model, o.status, o.failures, o.detail) for o in outcomes],
                                 "model string, status string, failures bigint, detail string")


def read_model(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A model's last published result."""
    return read_layer(spark, layer_root(root, name))


# ---- projects on disk --------------------------------------------------------------------------------


def _documents(folder: Path) -> list[dict]:
    try:
        import yaml
    except ImportError as e:
        raise ModelError("reading contracts from YAML needs the yaml package") from e
    return [yaml.safe_load(p.read_text(encoding="utf-8")) or {} for p in sorted([*folder.rglob("*.yml"), *folder.rglob("*.yaml")])]


def contract_of(entry: Mapping) -> ModelContract:
    """The contract that a YAML model entry declares: descriptions and ``not_null`` / ``unique`` tests of columns."""
    columns = []
    for c in entry.get("columns") or ():
        tests = tuple(c.get("tests") or c.get("data_tests") or ())
        strange = [t for t in tests if t not in TESTS]
        if strange:
            raise ModelError(f"{entry['name']}.{c['name']}: unknown test {strange[0]!r} (known: {', '.join(TESTS)})")
        columns.append(ColumnContract(c["name"], c.get("description") or "", tests))
    return ModelContract(entry["name"], entry.get("description") or "", tuple(columns))


def load_contracts(folder: str) -> dict[str, ModelContract]:
    """The contracts of all models that the folder's YAML files declare, by name."""
    entries = [m for d in _documents(Path(folder)) for m in d.get("models") or () if isinstance(m, Mapping)]
    return {m["name"]: contract_of(m) for m in entries}


def load_project(folder: str) -> tuple[list[Model], dict[str, str]]:
    """(models, sources) of a folder: a model for each ``*.sql`` file, named as the file, with its contract; for each declared
    source table ``group.table`` the path or table that its identifier names."""
    at = Path(folder)
    contracts = load_contracts(folder)
    models = [Model(p.stem, p.read_text(encoding="utf-8"), contract=contracts.get(p.stem)) for p in sorted(at.rglob("*.sql"))]
    sources = {}
    for group in [s for d in _documents(at) for s in d.get("sources") or ()]:
        for t in group.get("tables") or ():
            name = t.get("identifier") or t["name"]
            sources[f"{group['name']}.{t['name']}"] = name if "/" in name else f"{group.get('schema') or group['name']}.{name}"
    return models, sources
