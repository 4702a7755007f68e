"""Calls of outside recognisers, one row per item; errors become rows, never failed tasks.

A connector is any object with ``analyze(item: dict) -> dict`` and is made once per task by
its factory. ``Replay`` answers from a table and needs no network; ``Http`` posts JSON.
"""

from __future__ import annotations

import base64
import json
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTPUT = "image_id string, model_name string, success boolean, raw_text string, parsed string, error string, latency_ms bigint, vendor string, source_type string"


def message_text(value: object) -> str:
    """The text of a chat answer: choices, message, content or text, however nested."""
    if isinstance(value, str):
        return value
    if isinstance(value, list):
        return "".join(map(message_text, value))
    if isinstance(value, dict):
        for key in ("choices", "message", "content", "text", "output_text"):
            if value.get(key):
                inner = value[key]
                return message_text(inner[0] if key == "choices" and isinstance(inner, list) else inner)
    return ""


class Http:
    """Posts {prompt, image} as a chat request; on 400 or 422 once more without ``extra``."""

    def __init__(self, url: str, model: str, timeout: float = 180, extra: dict | None = None, key: str | None = None):
        self.url, self.model, self.timeout, self.extra, self.key = url, model, timeout, extra or {}, key

    def _post(self, body: dict) -> dict:
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        with urllib.request.urlopen(urllib.request.Request(self.url, json.dumps(body).encode(), headers), timeout=self.timeout) as r:
            return json.load(r)

    def analyze(self, item: dict) -> dict:
        content: list[dict] = [{"type": "text", "text": item.get("prompt") or ""}]
        if item.get("content"):
            url = f"data:{item.get('mime') or 'application/octet-stream'};base64,{base64.b64encode(item['content']).decode()}"
            content.append({"type": "image_url", "image_url": {"url": url}})
        body = {"model": self.model, "messages": [{"role": "user", "content": content}]}
        try:
            answer = self._post(body | self.extra)
        except urllib.error.HTTPError as e:
            if e.code not in (400, 422) or not self.extra:
                raise
            answer = self._post(body)
        return {"raw_text": message_text(answer), "parsed": json.dumps(answer)}


def call(items: DataFrame, model_name: str, factory: Callable[[], object], retries: int = 0, vendor: str = "", provider: str = "", wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """Answers of a connector to every item, with latency; retried after 2^attempt seconds."""
    names = [x.split()[0] for x in OUTPUT.split(", ")]
    kind = "local_service" if provider.endswith("_local") else "remote_service"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for pdf in frames:
            rows = []
            for item in pdf.to_dict("records"):
                began, got, error = time.perf_counter(), {}, None
                for attempt in range(retries + 1):
                    try:
                        got, error = client.analyze(item), None
                        break
                    except Exception as e:  # noqa: BLE001 - any failure is a row
                        error = f"{type(e).__name__}: {e}"
                        if attempt < retries:
                            wait(2**attempt)
                latency = int((time.perf_counter() - began) * 1000)
                rows.append((item["image_id"], model_name, error is None, got.get("raw_text"), got.get("parsed"), error, latency, vendor or provider, kind))
            yield pd.DataFrame(rows, columns=names)

    return items.mapInPandas(run, OUTPUT)


def replay(items: DataFrame, recorded: DataFrame, model_name: str) -> DataFrame:
    """Recorded answers instead of calls: the last captured per item, an error row where none is."""
    own = recorded.filter(F.col("model_name") == model_name)
    last = own.groupBy("image_id").agg(F.max_by(F.struct("success", "raw_text", "parsed", "error", "latency_ms", "vendor", "source_type"), F.struct("received_at", "output_id")).alias("r"))
    out = items.select("image_id").distinct().join(last, "image_id", "left")
    return out.select("image_id", F.lit(model_name).alias("model_name"), F.coalesce("r.success", F.lit(False)).alias("success"), "r.raw_text", "r.parsed", F.when(F.col("r").isNull(), "no recorded answer").otherwise(F.col("r.error")).alias("error"), F.col("r.latency_ms").cast("bigint").alias("latency_ms"), "r.vendor", "r.source_type")


#: Connectors by provider name; further ones register themselves here.
REGISTRY: dict[str, Callable] = {"http": Http}


def enabled(models: list[dict], timeout: float) -> list[dict]:
    """Enabled models of known providers with a default timeout."""
    return [{"timeout": timeout} | m for m in models if m.get("enabled", True) and m.get("provider") in REGISTRY]


class Upload:
    """Posts a picture to a parser service, as a form with a file or as base64 in JSON."""

    def __init__(self, url: str, form: bool = True, timeout: float = 180, fields: dict[str, str] | None = None):
        self.url, self.form, self.timeout, self.fields = url.rstrip("/"), form, timeout, fields or {}

    def body(self, item: dict) -> tuple[bytes, str]:
        """(body, content type) of an item's request."""
        name, content = item.get("file_name") or f"{item['image_id']}.png", item.get("content") or b""
        if not self.form:
            return json.dumps({**self.fields, "filename": name, "image": base64.b64encode(content).decode()}).encode(), "application/json"
        mark = uuid.uuid4().hex
        parts = [f'--{mark}\r\nContent-Disposition: form-data; name="{k}"\r\n\r\n{v}\r\n'.encode() for k, v in self.fields.items()]
        head = f'--{mark}\r\nContent-Disposition: form-data; name="file"; filename="{name}"\r\nContent-Type: {item.get("mime") or "application/octet-stream"}\r\n\r\n'
        return b"".join([*parts, head.encode(), content, f"\r\n--{mark}--\r\n".encode()]), f"multipart/form-data; boundary={mark}"

    def analyze(self, item: dict) -> dict:
        data, kind = self.body(item)
        with urllib.request.urlopen(urllib.request.Request(self.url, data, {"Content-Type": kind}), timeout=self.timeout) as r:
            answer = json.load(r)
        return {"raw_text": message_text(answer), "parsed": json.dumps(jsonable(answer), ensure_ascii=False)}


REGISTRY["upload"] = Upload


def jsonable(value: object) -> object:
    """A value as JSON can hold it: objects by their fields, tuples and sets as lists, bytes
    as base64, anything else as its text."""
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    if isinstance(value, dict):
        return {str(k): jsonable(v) for k, v in value.items()}
    if isinstance(value, (set, frozenset)):
        return sorted((jsonable(v) for v in value), key=str)
    if isinstance(value, (list, tuple)):
        return [jsonable(v) for v in value]
    if isinstance(value, bytes):
        return base64.b64encode(value).decode()
    return jsonable(vars(value)) if hasattr(value, "__dict__") else str(value)


def role_of(model: dict, prefixes: dict[str, str]) -> str:
    """A model's configured role, else the one of its provider's prefix, else the provider."""
    provider = str(model.get("provider") or "").strip().lower()
    named = str(model.get("role") or "").strip().lower()
    return named or next((role for prefix, role in prefixes.items() if provider.startswith(prefix)), provider)


def pick_role(models: list[dict], role: str, prefixes: dict[str, str]) -> dict | None:
    """The first model of a role."""
    return next((m for m in models if role_of(m, prefixes) == role.strip().lower()), None)


def request_control(mode: str, thinking_off: bool, applied: bool, fell_back: bool) -> dict:
    """What was asked of a request beside its text, and what came of it."""
    state = "disabled" if thinking_off and applied else "disabled_then_default" if thinking_off and fell_back else "default"
    return {"mode": mode.strip().lower() or "default", "thinking": state, "asked": thinking_off, "applied": applied, "fell_back": fell_back}


def with_control(answer: object, control: dict) -> dict:
    """An answer with its request's control; one that isn't an object is put under 'response'."""
    return {**(answer if isinstance(answer, dict) else {"response": answer}), "_request_control": dict(control)}


#: What a request says before its context, by mode.
CONTEXTS = {
    "seal": "These are candidates for the text of one seal. Choose one, or 'review' if none can be trusted. Answer with JSON only.",
    "flowchart": "This is a conflict between two flow diagrams. Texts read elsewhere may correct wording, never structure. Answer with a JSON patch only.",
    "primary": "This is a first structured result. Correct and complete it; don't write it anew.",
    "": "Further context:",
}


def prompt_text(prompt: str, mode: str, context: object) -> str:
    """The prompt and, below it, the context of a mode as JSON; an empty part is left out."""
    told = f"{CONTEXTS.get(mode.strip().lower(), CONTEXTS[''])}\n{json.dumps(jsonable(context), ensure_ascii=False, indent=2)}" if context else ""
    return "\n\n".join(part for part in (prompt.strip(), told) if part)
