"""Column mapping: which column of a table holds which field."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cadastra import schemas
from cadastra.config import EngineConfig
from cadastra.functions.text import WHITE, strip
from cadastra.operators.tables import sample_rows

# Heading words by field, in field order.
ALIASES = {
    "sr_no": ("sr", "sr.", "sr no", "s.no"),
    "applicant": ("applicant", "name of the applicant", "name"),
    "survey": ("sy", "survey", "sub-div", "sub div", "ch.", "pts"),
    "village_taluka": ("village", "taluka"),
    "existing_use": ("published", "existing", "rpg", "odp", "total area"),
    "proposed_use": ("proposed land", "proposed"),
    "area_proposed": ("area proposed", "in sq"),
    "decision": ("decision", "tcp board", "recommended"),
}
_POSITIONS = {
    "ndz": ("sr_no", "survey", "village_taluka", "existing_use", "proposed_use", "area_proposed", "decision"),
    "change_of_zone": schemas.FIELDS,
}
_NO_MAP = "cast(null as " + schemas.COLUMN_MAP + ")"


class Transport(Protocol):
    """Answers a prompt with text; the only way that the engine calls a language model."""

    def __call__(self, prompt: str) -> str: ...


_ALIASES = {f: re.compile(r"(?<![a-z0-9])(?:" + "|".join(map(re.escape, sorted(words, key=len, reverse=True))) + ")") for f, words in ALIASES.items()}
_SPACES = re.compile(f"[{re.escape(WHITE)}]+")
Choice = tuple[bool, str | None, dict[str, int] | None, float]


def _longest_alias(heading: str, field: str) -> int:
    """Length of the longest heading word of the field that starts a word, else 0."""
    return max((len(w) for w in _ALIASES[field].findall(heading)), default=0)


def _candidates(header: tuple[str | None, ...], hint: str | None) -> list[tuple[str, int, int]]:
    """Field, column and length of the heading word, the first to be taken first: longest first, then
    leftmost, then in field order."""
    names = [_SPACES.sub(" ", (h or "").strip(WHITE).lower()).strip(WHITE) for h in header]
    fields = [f for f in schemas.FIELDS if not (f == "applicant" and hint == "ndz")]
    found = [(f, i, n) for i, h in enumerate(names) for f in fields if (n := _longest_alias(h, f))]
    return sorted(found, key=lambda c: (-c[2], c[1]))


@lru_cache(maxsize=20_000)
def _choose(header: tuple[str | None, ...], hint: str | None) -> Choice:
    """Verdict, variant, columns and confidence of a heading row; a column and a field are used once."""
    picked: dict[str, int] = {}
    for field, col, _ in _candidates(header, hint):
        if field not in picked and col not in picked.values():
            picked[field] = col
    variant = hint if hint is not None else "change_of_zone" if "applicant" in picked else "ndz"
    if "survey" not in picked and (variant == "ndz" and "applicant" not in picked and len(header) == 7 or variant == "change_of_zone" and len(header) >= 8):
        picked = {f: i for i, f in enumerate(_POSITIONS[variant])}
    ok = "survey" in picked and "decision" in picked
    return (True, variant, picked, 0.9) if ok else (False, None, None, 0.3)


def _rows(header: pa.Array, hint: pa.Array) -> list[tuple[tuple[str | None, ...], str | None]]:
    return [(tuple(h or ()), v) for h, v in zip(header.to_pylist(), hint.to_pylist(), strict=True)]


def heuristic_map(header: Column, hint: Column) -> Column:
    """``is_39a, variant, column_map, confidence`` of a heading row.

    Few headings differ in a batch of gazettes, so each is read once and its answer taken for the
    others; a column expression would search every table's headings anew."""
    kind = pa.struct([("is_39a", pa.bool_()), ("variant", pa.string()), ("column_map", pa.struct([(f, pa.int32()) for f in schemas.FIELDS])), ("confidence", pa.float64())])

    @F.arrow_udf(f"struct<is_39a:boolean,variant:string,column_map:{schemas.COLUMN_MAP},confidence:double>")
    def run(header: pa.Array, hint: pa.Array) -> pa.Array:
        at: dict = {}
        index = [at.setdefault(row, len(at)) for row in _rows(header, hint)]
        said = [dict(zip(("is_39a", "variant", "column_map", "confidence"), _choose(*row), strict=True)) for row in at]
        return pa.array(said, kind).take(pa.array(index, pa.int32()))

    return run(header, hint)


def heading_candidates(header: Column, hint: Column) -> Column:
    """The candidates of a heading row, as an array of ``field, col, n``."""
    kind = pa.list_(pa.struct([("field", pa.string()), ("col", pa.int32()), ("n", pa.int32())]))

    @F.arrow_udf("array<struct<field:string,col:int,n:int>>")
    def run(header: pa.Array, hint: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(("field", "col", "n"), c, strict=True)) for c in _candidates(*row)] for row in _rows(header, hint)], kind)

    return run(header, hint)


def check_answer(answer: Column, n_cols: Column, samples: Column) -> Column:
    """A model's JSON answer as ``is_39a, variant, column_map, confidence``; null if unusable:
    no verdict, an index that is no column, survey or decision missing, one column twice, a shifted
    map (decision or area text in other columns) or an unknown variant."""
    raw = F.get_json_object(answer, "$.is_39a")
    index = {f: F.get_json_object(answer, f"$.column_map.{f}") for f in schemas.FIELDS}
    typed = {f: F.when(c.rlike(r"^-?\d+$"), c.try_cast("int")) for f, c in index.items()}
    # a quoted number is no index: JSON text keeps its quotes in the raw form of the object
    quoted = F.coalesce(F.get_json_object(answer, "$.column_map"), F.lit("")).rlike(r'"(?:' + "|".join(schemas.FIELDS) + r')"\s*:\s*"')
    valid = ~quoted
    for f in schemas.FIELDS:
        valid = valid & F.coalesce(index[f].isNull() | ((typed[f] >= 0) & (typed[f] < n_cols)), F.lit(False))
    used = F.filter(F.array(*typed.values()), lambda i: i.isNotNull())
    valid = valid & typed["survey"].isNotNull() & typed["decision"].isNotNull() & (F.size(used) == F.size(F.array_distinct(used)))
    said = lambda c: F.coalesce(F.lower(c).contains("recommend"), F.lit(False))
    shifted = F.exists(samples, lambda r: F.exists(r, said) & ~said(F.get(r, typed["decision"])))
    areas = F.filter(F.transform(samples, lambda r: F.coalesce(F.get(r, typed["area_proposed"]), F.lit(""))), lambda a: strip(a) != "")
    numberless = (F.size(areas) > 0) & ~F.exists(areas, lambda a: a.rlike(r"\d{2}"))
    variant = F.coalesce(F.nullif(F.get_json_object(answer, "$.variant"), F.lit("")), F.lit("change_of_zone"))
    valid = valid & ~shifted & ~numberless & variant.isin(*schemas.VARIANTS)
    nothing = F.expr(_NO_MAP)
    chosen = F.struct(*[typed[f].alias(f) for f in schemas.FIELDS])
    truthy = ~raw.isin("false", "0", "", "null")
    no = F.struct(F.lit(False).alias("is_39a"), F.lit(None).cast("string").alias("variant"), nothing.alias("column_map"), F.lit(0.5).alias("confidence"))
    yes = F.struct(F.lit(True).alias("is_39a"), variant.alias("variant"), chosen.alias("column_map"), F.lit(0.85).alias("confidence"))
    return F.when(raw.isNull(), None).when(~truthy, no).when(F.coalesce(valid, F.lit(False)), yes)


PROMPT = (
    "A table was cut from an official gazette. Say whether it lists Section 39A land-use applications and which column (by index) holds which field. "
    "Variant change_of_zone names an applicant; variant ndz (No Development Zone) has no applicant column. Answer with JSON only: "
    '{"is_39a": bool, "variant": "change_of_zone" or "ndz", "column_map": {'
    + ", ".join(f'"{f}": int or null' for f in schemas.FIELDS)
    + "}}. Table: "
)


def prompt(header: Column, samples: Column, hint: Column) -> Column:
    columns = F.transform(
        header, lambda h, i: F.struct(i.alias("index"), h.alias("header"), F.transform(F.slice(samples, 1, 3), lambda r: F.coalesce(F.get(r, i), F.lit(""))).alias("samples"))
    )
    return F.concat(F.lit(PROMPT), F.to_json(F.struct(columns.alias("columns"), hint.alias("variant_hint")), {"ignoreNullFields": "false"}))


def http_transport(url: str, model: str, *, api: str = "ollama", key: str | None = None, timeout: float = 120.0) -> Transport:
    """Transport to a model server, with the standard library only."""

    def call(text: str) -> str:
        from urllib.request import Request, urlopen

        if api == "ollama":
            path, body = "/api/generate", {"model": model, "prompt": text, "stream": False, "format": "json", "options": {"temperature": 0}}
        else:
            path, body = "/chat/completions", {"model": model, "messages": [{"role": "user", "content": text}], "response_format": {"type": "json_object"}}
        head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
        with urlopen(Request(url.rstrip("/") + path, json.dumps(body).encode(), head), timeout=timeout) as got:
            data = json.loads(got.read())
        return data["response"] if api == "ollama" else data["choices"][0]["message"]["content"]

    return call


def transport_of(cfg: EngineConfig) -> Transport | None:
    """The transport that the settings name; None for the heuristic alone."""
    if cfg.mapper == "heuristic":
        return None
    if cfg.mapper not in ("ollama", "openai_compat"):
        raise ValueError(f"unknown mapper: {cfg.mapper}")
    return http_transport(cfg.mapper_url, cfg.mapper_model, api=cfg.mapper, key=cfg.mapper_key or None)


def map_columns(tables: DataFrame, transport: Callable[[str], str] | None = None) -> DataFrame:
    """Adds ``mapped``.  The heuristic goes first; only tables it cannot map are sent through
    ``transport``, and any failure there leaves the heuristic's answer."""
    done = tables.withColumn("mapped", heuristic_map(F.col("header"), F.col("variant_hint")))
    if transport is None:
        return done

    def answers(batches):
        for batch in batches:
            said = []
            for p in batch.column(batch.num_columns - 1).to_pylist():
                try:
                    said.append(None if p is None else transport(p))
                except Exception:
                    said.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(said, pa.string())], names=[*batch.schema.names[:-1], "_answer"])

    # a step of its own, not a column expression: the answer is read many times below
    samples = sample_rows(F.col("rows"))
    question = F.when(~F.col("mapped.is_39a"), prompt(F.col("header"), samples, F.col("variant_hint")))
    schema = StructType([*done.schema.fields, StructField("_answer", StringType())])
    asked = done.withColumn("_prompt", question).mapInArrow(answers, schema)
    return asked.withColumn("mapped", F.coalesce(check_answer(F.col("_answer"), F.size("header"), samples), "mapped")).drop("_answer")


def infer_variant(header: Column) -> Column:
    return F.when(F.lower(F.array_join(header, " ")).contains("applicant"), "change_of_zone").otherwise("ndz")
