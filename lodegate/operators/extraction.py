"""Model answers: prompts, parsing, merging and the provider fallback chain."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lodegate.functions.batches import arrow_rows
from lodegate.functions.binding import json_value, let
from lodegate.functions.markup import is_object, kind
from lodegate.functions.text import unfenced, whole_number
from lodegate.scale import lookup_join
from lodegate.session import materialize

# Fixed value: instructions at the head of every prompt.
INSTRUCTIONS = (
    "Extract only facts explicitly supported by the supplied source text.\n"
    "Return only one JSON object matching the requested schema.\n"
    "Use null or empty values when evidence is absent. Do not guess, invent URLs, or infer missing facts.\n"
)

def labelled_text(**fields: Column) -> Column:
    """'Label: value' lines. Long texts are chunked first, a prompt each, and never cut."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"{label}: "), value) for label, value in fields.items()])


def prompt(text: Column, schema: dict, context: Column | None = None) -> Column:
    shape = json.dumps(schema, indent=2, sort_keys=True)
    head = F.lit("") if context is None else F.when(
        F.coalesce(context, F.lit("")) == "", ""
    ).otherwise(F.concat(F.lit("Source context: "), context, F.lit("\n\n")))
    return F.concat(F.lit(INSTRUCTIONS + "\n"), head, F.lit(f"JSON schema:\n{shape}\n\nSource text:\n"), text)


def parsed_answer(answer: Column) -> Column:
    """The JSON object of an answer as a variant; null for anything else."""
    return let(json_value(unfenced(answer)), lambda v: F.when(is_object(v), v))


def token_usage(usage: Column, field: str) -> Column:
    """An integer counter of a usage object; null for other types."""
    return let(
        F.try_variant_get(usage, f"$.{field}", "variant"),
        lambda v: F.when(kind(v) == "BIGINT", F.try_variant_get(v, "$", "bigint")),
    )


# Facts asked of a model per record kind, with type and default.
FACTS = {
    "job": (("company", "text", None), ("is_remote", "flag", False), ("role_family", "text", None)),
    "news": (("summary", "text", None), ("category", "text", "AI"), ("primary_entity", "text", None)),
    "startup": (("employee_count", "integer", None), ("headquarters", "text", None), ("founded_year", "integer", None)),
    "product": (("pricing_model", "text", "FREEMIUM"), ("startup_name", "text", None)),
}
_FACT_TYPES = {"text": "string", "flag": "boolean", "integer": "bigint"}


def facts(answer: Column, record_kind: str) -> Column:
    """Typed facts of a model answer; null when it is no object or a fact has the wrong type.

    A missing fact takes its default and a null one stays null, unless the fact
    has a default. Other keys are ignored.
    """
    fields = FACTS[record_kind]

    def read(value, type_name):
        text = F.try_variant_get(value, "$", "string")
        if type_name == "text":
            return F.when(kind(value) == "STRING", text)
        if type_name == "flag":
            words = F.lower(text)
            return F.when(words.isin("true", "1", "yes", "on", "t", "y"), F.lit(True)).when(
                words.isin("false", "0", "no", "off", "f", "n"), F.lit(False)
            )
        return F.when(kind(value) != "BOOLEAN", whole_number(text))

    def fact(node, name, type_name, default):
        value = F.try_variant_get(node, f"$.{name}", "variant")

        def judged(v):
            empty = F.is_variant_null(v)
            got = F.when(v.isNull(), F.lit(default).cast(_FACT_TYPES[type_name])).when(~empty, read(v, type_name))
            wrong = F.coalesce(empty & F.lit(default is not None), F.lit(False)) | (
                v.isNotNull() & ~F.coalesce(empty, F.lit(False)) & read(v, type_name).isNull()
            )
            return F.struct(got.alias("value"), wrong.alias("wrong"))

        return let(value, judged).alias(name)

    def typed(node):
        return let(
            F.struct(*[fact(node, *field) for field in fields]),
            lambda found: F.when(
                ~F.exists(F.array(*[found[name]["wrong"] for name, *_ in fields]), lambda wrong: wrong),
                F.struct(*[found[name]["value"].alias(name) for name, *_ in fields]),
            ),
        )

    return let(parsed_answer(answer), lambda node: F.when(node.isNotNull(), typed(node)))


# Merging ---------------------------------------------------------------------

_LEAVES = T.ArrayType(
    T.StructType(
        [T.StructField(name, T.StringType()) for name in ("parent", "name", "kind", "item", "value")]
        + [T.StructField(name, T.IntegerType()) for name in ("depth", "position", "copy")]
    )
)


def _same(value):
    """Equal values get equal forms: 1, 1.0 and true compare equal."""
    if isinstance(value, dict):
        return {key: _same(inner) for key, inner in value.items()}
    if isinstance(value, list):
        return [_same(inner) for inner in value]
    if isinstance(value, (bool, float)) and value == int(value):
        return int(value)
    return value


def _leaves(value, parent: str = "", name: str = "", depth: int = 0) -> Iterator[dict]:
    """A row for each path; quoted names in a row are a path, as no quoted name holds a bare quote."""
    row = {"parent": parent, "name": name, "kind": "scalar", "item": None, "value": json.dumps(value, sort_keys=True), "depth": depth, "position": 0, "copy": 0}
    if value is None or value == {} or value == []:
        yield row | {"kind": "empty"}
    elif isinstance(value, dict):
        yield row | {"kind": "object", "value": None}
        for key, inner in value.items():
            yield from _leaves(inner, parent + name, json.dumps(key), depth + 1)
    elif isinstance(value, list):
        yield row | {"kind": "list", "value": None}
        copies: dict[str, int] = {}
        for position, inner in enumerate(value):
            item = json.dumps(_same(inner), sort_keys=True)
            copies[item] = copies.get(item, -1) + 1
            yield row | {
                "kind": "item", "item": item, "value": json.dumps(inner, sort_keys=True), "position": position, "copy": copies[item],
            }
    else:
        yield row


@F.arrow_udf(_LEAVES)
def _leaf_rows(payloads: pa.Array) -> pa.Array:
    return arrow_rows(payloads, lambda text: list(_leaves(json.loads(text))), _LEAVES)


_NODE = ["_key", "parent", "name"]


def _joined(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``text`` of each key's rows in the order of ``at``, by commas.

    The rows are cut into ranges of key and order, so that the rows of a large key are joined in many
    tasks, and only their texts, one a range, meet.
    """

    def in_order(at: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), "text"))), lambda row: row["text"]), ", ")

    # Written down, so that the ranges stay as they are if a task is run again.
    ranges = materialize(rows.repartitionByRange(*keys, "at").withColumn("range", F.spark_partition_id()), "ranges")
    return ranges.groupBy(*keys, "range").agg(in_order("at").alias("text")).groupBy(*keys).agg(in_order("range").alias("text"))


def merge_extractions(parts: DataFrame, key: str, order: str, payload: str) -> DataFrame:
    """Merge the JSON objects of each key in ``order`` into one.

    At every path the first non-empty value decides: objects merge with later
    objects, lists gain the unseen items of later lists, scalars stay. Null,
    {} and [] are empty; "", 0 and false are not. The parts become one row per
    path and the decisions are map-side aggregates per path. Objects are put together from the
    deepest level up, a round each, and lists and objects range by range, so no task holds
    the rows of a key. Null is a key as any other; a key without payloads gives no row. Names
    in an object ascend by their escaped form.
    """
    split = parts.select(F.struct(key).alias("_key"), F.col(order).alias("_seq"), F.explode(_leaf_rows(F.col(payload))).alias("_leaf"))
    leaves = materialize(split.select("_key", "_seq", "_leaf.*"), "leaves")
    full = F.col("kind") != "empty"
    chosen = materialize(
        leaves.filter(F.col("kind") != "item")
        .groupBy(*_NODE, "depth")
        .agg(
            F.min(F.when(full, F.struct("_seq", "kind", "value"))).alias("_first"),
            F.max(F.when(~full, F.struct("_seq", "value"))).alias("_last_empty"),
        )
        .select(
            *_NODE,
            "depth",
            F.coalesce("_first.kind", F.lit("empty")).alias("kind"),
            F.coalesce("_first.value", "_last_empty.value").alias("value"),
            F.col("_first._seq").alias("_from"),
        ),
        "nodes",
    )
    earliest = (
        leaves.filter(F.col("kind") == "item")
        .groupBy(*_NODE, "item", "copy")
        .agg(F.min(F.struct("_seq", "position", "value")).alias("_at"))
    )
    lists = chosen.filter(F.col("kind") == "list").select(*_NODE, "_from")
    kept = lookup_join(earliest, lists, _NODE, "inner", spread=F.col("item")).filter(
        (F.col("copy") == 0) | (F.col("_at._seq") == F.col("_from"))
    )
    placed = kept.select(*_NODE, F.struct("_at._seq", "_at.position").alias("at"), F.col("_at.value").alias("text"))
    items = materialize(_joined(placed, _NODE), "lists")
    below = None
    for depth in range(chosen.agg(F.max("depth")).first()[0] or 0, 0, -1):
        nodes = chosen.filter(F.col("depth") == depth)
        texts = nodes.filter(F.col("kind").isin("scalar", "empty")).select(*_NODE, F.col("value").alias("text"))
        full_lists = _filled(nodes.filter(F.col("kind") == "list"), items, "[", "]")
        objects = _filled(nodes.filter(F.col("kind") == "object"), below, "{", "}")
        fields = texts.unionByName(full_lists).unionByName(objects)
        at = F.expr("substring(name, 2, length(name) - 2)").alias("at")
        field = F.concat("name", F.lit(": "), "text").alias("text")
        below = _joined(fields.select("_key", F.col("parent").alias("path"), at, field), ["_key", "path"])
    roots = chosen.filter(F.col("depth") == 0).select("_key", *[F.lit("").alias(name) for name in _NODE[1:]])
    return _filled(roots, below, "{", "}").select(F.col(f"_key.{key}").alias(key), F.col("text").alias("merged"))


def _filled(nodes: DataFrame, content: DataFrame | None, opening: str, closing: str) -> DataFrame:
    """The text of lists or objects from that of their content."""
    if content is None:
        return nodes.select(*_NODE, F.lit(opening + closing).alias("text"))
    wide = nodes.select(*_NODE, F.concat("parent", "name").alias("path"))
    keys = [name for name in ("parent", "name", "path") if name in content.columns]
    joined = wide.join(content, ["_key", *keys], "left")
    return joined.select(*_NODE, F.concat(F.lit(opening), F.coalesce("text", F.lit("")), F.lit(closing)).alias("text"))


# Providers -------------------------------------------------------------------


def provider_health(attempts: DataFrame) -> DataFrame:
    """Successes, failures, attempts and failure rate per provider."""
    return attempts.groupBy("provider").agg(
        F.count_if("succeeded").alias("successes"),
        F.count_if(~F.col("succeeded")).alias("failures"),
        F.count(F.lit(1)).alias("attempts"),
        (F.count_if(~F.col("succeeded")) / F.count(F.lit(1))).alias("failure_rate"),
    )


def fallback_order(providers: DataFrame, health: DataFrame) -> DataFrame:
    """Providers by failure rate, then configured position; unused ones have rate zero.

    ``providers`` is the configuration (provider, position), a handful of rows.
    """
    rated = providers.join(health, "provider", "left").na.fill(0.0, ["failure_rate"]).na.fill(
        0, ["successes", "failures", "attempts"]
    )
    return rated.withColumn("rank", F.row_number().over(Window.orderBy("failure_rate", "position")))


def fallback_result(attempts: DataFrame, request: str) -> DataFrame:
    """Outcome of each request tried on providers in rank order.

    ``attempts`` has rank, provider, succeeded and falls_back, one row per
    provider asked. The first success wins unless an earlier failure forbids
    going on.
    """
    result = attempts.groupBy(request).agg(
        F.min(F.when(F.col("succeeded"), F.struct("rank", "provider"))).alias("_won"),
        F.min(F.when(~F.col("succeeded") & ~F.col("falls_back"), F.col("rank"))).alias("_stopped"),
    )
    won = F.col("_won.rank").isNotNull() & (F.col("_stopped").isNull() | (F.col("_won.rank") < F.col("_stopped")))
    return result.select(
        request,
        F.when(won, "succeeded").when(F.col("_stopped").isNotNull(), "failed").otherwise("exhausted").alias("outcome"),
        F.when(won, F.col("_won.provider")).alias("provider"),
    )
