"""Nested records into flat tables by Merkle subtree identities.

Every JSON object of a record is canonicalised bottom-up: keys are sorted, numbers and
strings are written in one form, and each child object is replaced by its own hash. The
hash of that canonical text is the object's identity, so equal subtrees get one identity
wherever they occur. ``bridge`` keeps every occurrence (record, pre-order number, parent's
number, field, places in arrays, identity); the ``store`` keeps every identity once with all
its fields; ``flat`` joins the two on the identity.

In canonical text ``{"#": identity}`` stands for a child object and ``{"json": value}`` for
JSON that was held in a string.

Defined results: null and empty payloads give no rows; malformed ones and those nested
deeper than the parser goes give none either, and ``rejects`` names them; JSON held in a
string is opened if it holds an object or a list; an id that is null isn't an id; repeated
records keep their own rows; an id met twice under the same parent within one record gives
two bridge rows and, with ``distinct_links``, one; of a member named twice the last counts.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from json.encoder import encode_basestring_ascii as quoted

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordance.session import materialise

#: ``places``: where the object stands in the arrays of its field, outermost first ('2.0');
#: ``ordinal``: the last of them, 0 outside arrays.
BRIDGE = (
    "source_table string, record_id bigint, occurrence int, parent_occurrence int, field string, "
    "places string, ordinal int, object_hash string, id_key string, child_id string, parent_id string"
)
OBJECTS = "object_hash string, id_key string, canonical string, child_objects int"


def _scalar(value: object) -> str:
    """The canonical text of a scalar; 1.0 and 1 are one number."""
    if value is None:
        return "null"
    if value is True:
        return "true"
    if value is False:
        return "false"
    if isinstance(value, float):
        if value.is_integer() and abs(value) < 1e15:
            return str(int(value))
        if value != value or value in (float("inf"), float("-inf")):
            return quoted(str(value))
    return repr(value)


class _Walker:
    """Hashes one record's objects bottom-up, numbering occurrences in pre-order."""

    def __init__(self, id_keys: tuple[str, ...], texts: tuple[str, ...] = ()):
        self.id_keys = id_keys
        self.texts = texts
        self.rows: list[list] = []
        self.objects: dict[str, tuple] | None = None
        self.received: dict[int, dict[str, str]] = {}

    def walk(self, value: object, parent: int, owner: str, field: str, places: str) -> str:
        if isinstance(value, dict):
            return self._object(value, parent, owner, field, places)
        if isinstance(value, list):
            below = places + "." if places else ""
            return "[" + ",".join([self.walk(v, parent, owner, field, f"{below}{k}") if isinstance(v, (dict, list, str)) else _scalar(v) for k, v in enumerate(value)]) + "]"
        if isinstance(value, str):
            head = value[:1] if value[:1] > " " else value.lstrip()[:1]
            if head == "{" or head == "[":
                try:
                    inner = json.loads(value)
                except (ValueError, RecursionError):
                    return quoted(value)
                return '{"json":' + self.walk(inner, parent, owner, field, places) + "}"
            return quoted(value)
        return _scalar(value)

    def _object(self, value: dict, parent: int, owner: str, field: str, places: str) -> str:
        number = len(self.rows)
        own = key = None
        for k in self.id_keys:
            found = value.get(k)
            if found is not None and not isinstance(found, (dict, list)):
                own, key = found if isinstance(found, str) else _scalar(found), k
                break
        row = [number, parent, field, places, int(places.rpartition(".")[2] or 0), "", key, own, owner]
        self.rows.append(row)
        inside = owner if own is None else own
        parts, children = [], 0
        for k in sorted(value):
            v = value[k]
            if isinstance(v, (dict, list, str)):
                before = len(self.rows)
                parts.append(quoted(k) + ":" + self.walk(v, number, inside, k, ""))
                children += len(self.rows) > before
            else:
                parts.append(quoted(k) + ":" + _scalar(v))
        for k in self.texts:
            v = value.get(k)
            if isinstance(v, str) and v.lstrip()[:1] in ("{", "["):
                self.received.setdefault(number, {})[k] = v
        canonical = "{" + ",".join(parts) + "}"
        identity = blake2b(canonical.encode(), digest_size=16).hexdigest()
        row[5] = identity
        if self.objects is not None and identity not in self.objects:
            self.objects[identity] = (key, canonical, children)
        return '{"#":"' + identity + '"}'


def _loaded(payload: str | None) -> object:
    if not payload:
        return None
    try:
        return json.loads(payload)
    except (ValueError, RecursionError):
        return None


def bridge(df: DataFrame, source: str, record: str, payload: str, id_keys: tuple[str, ...], identified_only: bool = False, distinct_links: bool = False, objects: bool = False, texts: tuple[str, ...] = ()) -> DataFrame:
    """One row for every occurrence of an object in ``payload``.

    ``parent_id`` is the id of the nearest enclosing object that has one, '' if none.
    ``identified_only`` keeps the objects with an own id (all are hashed all the same);
    ``distinct_links`` keeps one row per record and (own id, parent's id), without a shuffle
    since a record is never split; ``objects`` adds canonical text and number of child
    objects where an identity is met for the first time in its batch (else null); ``texts``
    names fields whose strings are kept as received, as JSON in the column ``received``,
    where canonical text may have them opened (else null).
    """
    schema = BRIDGE + (", canonical string, child_objects int" if objects else "") + (", received string" if texts else "")
    names = [x.split()[0] for x in schema.split(", ")]
    types = [{"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(200_000)
        for batch in batches:
            seen: set[str] = set()
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                out: list[list] = []
                ids: list[int] = []
                for rid, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    walker = _Walker(id_keys, texts)
                    if objects:
                        walker.objects = {}
                    walker.walk(_loaded(text), -1, "", "", "")
                    rows = walker.rows
                    if objects:
                        for r in rows:
                            if r[5] in seen:
                                r += (None, None)
                            else:
                                seen.add(r[5])
                                r += walker.objects[r[5]][1:]
                    if texts:
                        for r in rows:
                            r.append(json.dumps(walker.received[r[0]]) if r[0] in walker.received else None)
                    if identified_only:
                        rows = [r for r in rows if r[7] is not None]
                    if distinct_links:
                        rows = list({(r[7], r[8]): r for r in rows}.values())
                    out += rows
                    ids += [rid] * len(rows)
                columns = list(zip(*out)) if out else [[]] * (len(names) - 2)
                data = [pa.array([source] * len(ids), types[0]), pa.array(ids, types[1]), *(pa.array(c, t) for c, t in zip(columns, types[2:]))]
                yield pa.RecordBatch.from_arrays(data, names)

    narrow = df.select(F.col(record).cast("bigint").alias("record_id"), F.col(payload).cast("string").alias("payload"))
    return narrow.filter("payload is not null").mapInArrow(run, schema)


def store(*bridged: DataFrame) -> DataFrame:
    """Every distinct object once, under its identity, from bridges with ``objects``.

    Copies were dropped within a batch before the shuffle on the identity, so a payload
    that a third of all records repeat is sent once per batch.
    """
    rows = reduce(DataFrame.unionAll, [b.filter("canonical is not null").select("object_hash", "id_key", "canonical", "child_objects") for b in bridged])
    return rows.groupBy("object_hash").agg(*(F.first(c).alias(c) for c in ("id_key", "canonical", "child_objects")))


def flat(bridged: DataFrame, id_key: str, fields: str, whole: str = "content", texts: tuple[str, ...] = ()) -> DataFrame:
    """The flat table of the objects whose id is ``id_key``: every occurrence joined with its
    stored object. ``fields`` become columns; ``whole`` names the column that has all fields,
    as canonical JSON, and must differ from them. ``texts``: the string fields that come out
    as received, even if they hold JSON.

    ``bridged``: a bridge with ``objects`` and these ``texts``, written once. An identity that a third of all
    occurrences share is one row on the store's side, and adaptive execution splits its
    occurrences.
    """
    own = bridged.filter(F.col("id_key") == id_key)
    stored = store(own).select("object_hash", "canonical")
    rows = own.drop("canonical", "child_objects").join(stored, "object_hash")
    read = F.from_json("canonical", fields)
    for name in texts:
        read = read.withField(name, F.coalesce(F.from_json("received", "map<string, string>")[name], read[name]))
    return rows.select("record_id", "occurrence", "parent_occurrence", "parent_id", "field", "places", "ordinal", "object_hash", F.col("child_id").alias(id_key), read.alias("own"), F.col("canonical").alias(whole)).select("*", "own.*").drop("own")


def rejects(df: DataFrame, source: str, record: str, payload: str) -> DataFrame:
    """(source_table, record_id, reason) of payloads that can't be read: 'malformed' or 'too_deep'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    json.loads(text)
                except RecursionError:
                    out.append((rid, "too_deep"))
                except ValueError:
                    out.append((rid, "malformed"))
            yield pa.RecordBatch.from_arrays([pa.array([source] * len(out), pa.string()), pa.array([r for r, _ in out], pa.int64()), pa.array([w for _, w in out], pa.string())], ["source_table", "record_id", "reason"])

    narrow = df.select(F.col(record).cast("bigint").alias("record_id"), F.col(payload).cast("string").alias("payload"))
    return narrow.filter("payload != ''").mapInArrow(run, "source_table string, record_id bigint, reason string")


def identified(bridged: DataFrame) -> DataFrame:
    """(source_table, record_id, child_id, parent_id) of the objects with an id."""
    return bridged.filter("child_id is not null").select("source_table", "record_id", "child_id", "parent_id")


#: source table -> (record key, payload column, keys that are ids)
SOURCES = {
    "model_outputs": ("output_id", "parsed", ("block_id",)),
    "layout_blocks": ("block_row_id", "raw", ("line_id", "span_id")),
    "validations": ("validation_id", "details", ("check_id", "finding_id", "evidence_id")),
}


def payloads(df: DataFrame, source: str) -> DataFrame:
    """The record key and its payload as JSON text; a struct payload is written as JSON."""
    record, payload, _ = SOURCES[source]
    column = F.col(payload)
    if dict(df.dtypes)[payload] != "string":
        column = F.to_json(column)
    return df.select(F.col(record).alias("record_id"), column.alias("payload"))


def bridge_of(df: DataFrame, source: str, **how: bool | tuple[str, ...]) -> DataFrame:
    """``bridge`` over one of the declared source tables."""
    return bridge(payloads(df, source), source, "record_id", "payload", SOURCES[source][2], **how)


def written(df: DataFrame, source: str, texts: tuple[str, ...] = ()) -> DataFrame:
    """The bridge of a declared source with its objects, written once for several readers."""
    return materialise(bridge_of(df, source, objects=True, texts=texts))
