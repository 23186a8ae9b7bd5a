"""Contract check on raw message text: which fields are missing, null or mistyped.

The typed parse cannot answer this, because an absent field and a field of the wrong type
both come out as NULL. The text is parsed once into a variant and its objects are taken
apart once, into maps; each field is looked up there by its type name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.once import evaluated_once
from gaugeflow.operators.rules import DECLARED

MISSING, NULL, MISTYPED, UNREADABLE = "missing", "null", "mistyped", "unreadable"
UNKNOWN = "unknown"


@dataclass(frozen=True)
class Field:
    """A field every message must have, or every message of one device type.

    An ``optional`` field may be absent or null; its type is checked where it is present.
    ``values`` are the texts allowed, if not all are.
    """

    path: str
    kinds: tuple[str, ...]
    device_type: str | None = None
    optional: bool = False
    values: tuple[str, ...] = ()


_TEXT = ("STRING",)
_WHOLE = ("BIGINT",)
_NUMBER = ("BIGINT", "DECIMAL", "DOUBLE")
_OBJECT = ("OBJECT",)

# The metrics each device type reports are those with a declared range.
METRICS = {
    kind: tuple(rule.metric for rule in DECLARED if rule.device_type == kind)
    for kind in dict.fromkeys(rule.device_type for rule in DECLARED)
}
# Required and optional fields.
REQUIRED = (
    Field("event_id", _TEXT),
    Field("device_id", _TEXT),
    Field("device_type", _TEXT, values=tuple(METRICS)),
    Field("timestamp", _WHOLE),
    Field("readings", _OBJECT),
)
OPTIONAL = tuple(
    Field(path, kinds, optional=True)
    for path, kinds in {
        "metadata": _OBJECT,
        "metadata.location": _OBJECT,
        "metadata.location.building": _TEXT,
        "metadata.location.floor": _WHOLE,
        "metadata.location.zone": _TEXT,
        "metadata.firmware_version": _TEXT,
        "metadata.signal_strength": _WHOLE,
        "metadata.battery_level": _WHOLE,
        "metadata.anomaly_detected": ("BOOLEAN", *_TEXT),
        "metadata.anomaly_type": _TEXT,
        "metadata.status": _TEXT,
        "metadata.error": _TEXT,
    }.items()
)
CONTRACT = REQUIRED + OPTIONAL + tuple(
    Field(f"readings.{metric}", _NUMBER, kind)
    for kind, metrics in METRICS.items()
    for metric in metrics
)


def _parents(contract: tuple[Field, ...]) -> list[str]:
    """Paths of the objects that hold the fields, outer ones first; '' is the message."""
    held = {""}
    for field in contract:
        steps = field.path.split(".")[:-1]
        held.update(".".join(steps[: i + 1]) for i in range(len(steps)))
    return sorted(held, key=lambda path: (path.count(".") + bool(path), path))


def _value(path: str) -> Column:
    """The variant at ``path``, by way of the map of the object around it."""
    parent, _, name = path.rpartition(".")
    return F.col(f"`_in_{parent}`")[name]


def _kind(field: Field) -> Column:
    """Type name of the field's value without its parameters; NULL when absent."""
    found = F.schema_of_variant(_value(field.path))
    name = F.substring_index(F.substring_index(found, "<", 1), "(", 1)
    if field.device_type is None:
        return name
    return F.when(F.col("device_type") == field.device_type, name)


def _violation(field: Field, kind: Column, text: Column) -> Column:
    absent = (None, None) if field.optional else (MISSING, NULL)
    verdict = (
        F.when(kind.isNull(), absent[0])
        .when(kind == "VOID", absent[1])
        .when(~kind.isin(*field.kinds), MISTYPED)
    )
    if field.values:
        verdict = verdict.when(~text.isin(*field.values), UNKNOWN)
    if field.device_type is not None:
        verdict = F.when(F.col("device_type") == field.device_type, verdict)
    entry = F.struct(F.lit(field.path).alias("field"), verdict.alias("violation"))
    return F.when(verdict.isNotNull(), entry)


def violations(messages: DataFrame, contract: tuple[Field, ...] = CONTRACT) -> DataFrame:
    """One row per broken field of every message: device_type, field, violation.

    A message that is not JSON is one violation of the whole document. The kind of each
    field is a column of its own before the rows are expanded, so that it is looked up
    once however often the verdict mentions it.
    """
    text = F.col("value").cast("string")
    parsed = messages.select(evaluated_once(F.try_parse_json(text)).alias("document"))
    kinds = {f"_k{i}": field for i, field in enumerate(contract)}
    apart = parsed
    for path in _parents(contract):
        whole = _value(path) if path else F.col("document")
        fields = F.try_variant_get(whole, "$", "map<string,variant>")
        apart = apart.withColumn(f"_in_{path}", evaluated_once(fields))
    apart = apart.withColumn(
        "device_type", F.try_variant_get("document", "$.device_type", "string")
    )
    looked_up = apart.select(
        "device_type",
        F.col("document").isNull().alias("_unreadable"),
        *[_kind(field).alias(name) for name, field in kinds.items()],
        *[
            F.try_variant_get(_value(field.path), "$", "string").alias(f"{name}_text")
            for name, field in kinds.items()
            if field.values
        ],
    )
    whole = F.struct(F.lit("$").alias("field"), F.lit(UNREADABLE).alias("violation"))
    broken = F.when(F.col("_unreadable"), F.array(whole)).otherwise(
        F.array_compact(F.array(*[_violation(f, F.col(k), F.col(f"{k}_text")) for k, f in kinds.items()]))
    )
    return looked_up.select("device_type", F.inline(broken))


def contract_violations(
    messages: DataFrame, contract: tuple[Field, ...] = CONTRACT
) -> DataFrame:
    """Violations counted per device type and field."""
    return (
        violations(messages, contract)
        .groupBy("device_type", "field", "violation")
        .agg(F.count("*").alias("message_count"))
    )


@dataclass(frozen=True)
class Change:
    """What a contract version changes about a field.

    It breaks *backward* if messages that the old version allows can be broken by the new one,
    *forward* if messages that the new one allows can be broken by the old one.
    """

    path: str
    device_type: str | None
    change: str
    backward: bool = False
    forward: bool = False


def compare(old: tuple[Field, ...], new: tuple[Field, ...]) -> list[Change]:
    """Every difference of two contract versions, by field.

    Fields that a version does not name are not written by its producers, so adding an
    optional field, or no longer naming one, breaks nothing.
    """
    key = lambda field: (field.path, field.device_type)
    before, after = ({key(field): field for field in contract} for contract in (old, new))
    changes = []
    for path, kind in dict.fromkeys([*before, *after]):
        was, now = before.get((path, kind)), after.get((path, kind))
        if was is None:
            changes.append(Change(path, kind, "added", backward=not now.optional))
        elif now is None:
            changes.append(Change(path, kind, "removed", forward=not was.optional))
        else:
            changes.extend(_differences(path, kind, was, now))
    return changes


def _differences(path: str, kind: str | None, was: Field, now: Field) -> list[Change]:
    found = []
    if was.optional != now.optional:
        told = "made optional" if now.optional else "made required"
        found.append(Change(path, kind, told, backward=was.optional, forward=now.optional))
    for name, old, new in (("types", was.kinds, now.kinds), ("values", was.values, now.values)):
        # No values listed means that all are allowed.
        lost = bool(new) and (not old or not set(old) <= set(new))
        gained = bool(old) and (not new or not set(new) <= set(old))
        if lost or gained:
            told = "changed" if lost and gained else "narrowed" if lost else "widened"
            found.append(Change(path, kind, f"{name} {told}", backward=lost, forward=gained))
    return found


def readable(old: tuple[Field, ...], new: tuple[Field, ...]) -> str:
    """How two versions go together: both, backward, forward or none."""
    changes = compare(old, new)
    backward = not any(c.backward for c in changes)
    forward = not any(c.forward for c in changes)
    return {(True, True): "both", (True, False): "backward", (False, True): "forward"}.get(
        (backward, forward), "none"
    )


def version_impact(
    messages: DataFrame, old: tuple[Field, ...], new: tuple[Field, ...]
) -> DataFrame:
    """One row per change, with the messages that violate the field under either version.

    Each version is checked for its changed fields only, in one pass over the messages.
    """
    changes = compare(old, new)
    spark = messages.sparkSession
    places = {(c.path, c.device_type) for c in changes}
    rows = spark.createDataFrame(
        [(c.path, c.device_type, c.change, c.backward, c.forward) for c in changes],
        "field string, kind string, change string, breaks_backward boolean, breaks_forward boolean",
    )
    for name, contract in (("old_violations", old), ("new_violations", new)):
        checked = tuple(f for f in contract if (f.path, f.device_type) in places)
        typed = sorted({f.path for f in checked if f.device_type is not None})
        kind = F.when(F.col("field").isin(*typed), F.col("device_type")).alias("_kind")
        counts = violations(messages, checked).groupBy(F.col("field").alias("_field"), kind).agg(
            F.count("*").alias(name)
        )
        same = (F.col("field") == F.col("_field")) & F.col("kind").eqNullSafe(F.col("_kind"))
        rows = rows.join(counts, same, "left").drop("_field", "_kind").fillna(0, [name])
    return rows
