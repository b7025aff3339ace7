"""Requests to a vision model as a column: the whole body, so that a job can be replayed and checked without the service."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The answer's fields, and the limits a request states.
BRAND_FIELDS = ("brand", "basis", "evidence", "visible_text")
JUDGE_FIELDS = ("category", "reason")
MAX_TOKENS = 400


def answer_schema(fields: tuple[str, ...], choices: Mapping[str, tuple[str, ...]] | None = None) -> dict:
    """JSON schema of a flat answer of required text fields; ``choices`` lists the words a field may have."""
    allowed = choices or {}
    text = {f: {"type": "string"} | ({"enum": list(allowed[f])} if f in allowed else {}) for f in fields}
    return {"type": "object", "properties": text, "required": list(fields), "additionalProperties": False}


def _constant(value) -> Column:
    """A nested constant as a column: mappings become structs, lists arrays."""
    if isinstance(value, Mapping):
        return F.struct(*[_constant(v).alias(k) for k, v in value.items()])
    if isinstance(value, (list, tuple)):
        return F.array(*[_constant(v) for v in value])
    return F.lit(value)


# The names of all fields below are those of the chat completion interface.
def chat_request(
    image: Column, prompt: str, schema: Mapping, *, name: str, model: str = "", temperature: float = 0.0, max_tokens: int = MAX_TOKENS,
    thinking: bool = False, media: str = "image/jpeg",
) -> Column:
    """Body of a chat completion about one encoded picture (``image`` is binary), answered in ``schema``.

    One struct of all fields; those that a request doesn't state are null, and JSON leaves nulls out.
    """
    encoded = F.replace(F.base64(image), F.lit("\r\n"), F.lit(""))
    picture = F.struct(F.concat(F.lit(f"data:{media};base64,"), encoded).alias("url"))
    part = lambda kind, text, url: F.struct(F.lit(kind).alias("type"), text.alias("text"), url.alias("image_url"))
    shown, asked = part("image_url", F.lit(None).cast("string"), picture), part("text", F.lit(prompt), F.lit(None).cast("struct<url:string>"))
    answer = _constant({"type": "json_schema", "json_schema": {"name": name, "schema": schema, "strict": True}})
    said = F.array(F.struct(F.lit("user").alias("role"), F.array(shown, asked).alias("content")))
    quiet = F.lit(None).cast("struct<enable_thinking:boolean>") if thinking else _constant({"enable_thinking": False})
    return F.to_json(
        F.struct(
            F.nullif(F.lit(model), F.lit("")).alias("model"),
            said.alias("messages"),
            answer.alias("response_format"),
            F.lit(temperature).alias("temperature"),
            F.lit(max_tokens).alias("max_tokens"),
            quiet.alias("chat_template_kwargs"),
        )
    )
