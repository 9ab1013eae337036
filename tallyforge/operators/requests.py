"""Requests to a model as rows, and the fold of what they used (§2.13 model calls).

A request's body is a column: JSON with the instructions as a block that may be
cached, the document as page images, as a file or as text only, and the schema of
the answer as the one tool. Failures of a call are told apart by its status:
what another try may mend, and what makes the provider unavailable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses of a refused request, and those worth another try.
REFUSED = (400, 401, 402, 403)
AGAIN = (408, 409, 429, 500, 502, 503, 504, 529)
#: the ttl that a provider takes for granted, so it is not sent
DEFAULT_TTL = "5m"


def request_body(model: str, *, max_tokens: int = 8192, temperature: float = 0.0, cache_ttl: str | None = DEFAULT_TTL) -> Column:
    """JSON body of a row with system, user_text, pdf, images, schema_name, schema_description, json_schema.

    Page images come before a file, a file before text alone; ``user_text``
    always follows. Null pdf and null or empty images are not sent. Without
    ``cache_ttl`` nothing is cached. ``json_schema`` is JSON text and is put in as
    it stands. All other values are escaped.
    """
    cached = "" if cache_ttl is None else ',"cache_control":{"type":"ephemeral"' + ("" if cache_ttl == DEFAULT_TTL else f',"ttl":"{cache_ttl}"') + "}"

    def text(value: Column) -> Column:
        # to_json quotes and escapes; the value alone is cut out of {"v":...}
        quoted = F.to_json(F.struct(F.coalesce(value, F.lit("")).alias("v")))
        return F.substring(quoted, F.lit(6), F.length(quoted) - 6)

    def source(kind: str, media: str, data: Column) -> Column:
        return F.concat(F.lit(f'{{"type":"{kind}","source":{{"type":"base64","media_type":"{media}","data":"'), F.base64(data), F.lit('"}}'))

    images = F.filter(F.coalesce("images", F.array().cast("array<binary>")), lambda i: i.isNotNull())
    parts = F.when(F.size(images) > 0, F.transform(images, lambda i: source("image", "image/png", i))).when(F.col("pdf").isNotNull(), F.array(source("document", "application/pdf", F.col("pdf")))).otherwise(F.array().cast("array<string>"))
    content = F.array_join(F.array_append(parts, F.concat(F.lit('{"type":"text","text":'), text(F.col("user_text")), F.lit("}"))), ",")
    return F.concat(
        F.lit(f'{{"model":"{model}","max_tokens":{max_tokens},"temperature":{temperature},"system":[{{"type":"text","text":'),
        text(F.col("system")),
        F.lit(f'{cached}}}],"messages":[{{"role":"user","content":['),
        content,
        F.lit(']}],"tools":[{"name":'),
        text(F.col("schema_name")),
        F.lit(',"description":'),
        text(F.col("schema_description")),
        F.lit(',"input_schema":'),
        F.coalesce("json_schema", F.lit("{}")),
        F.lit('}],"tool_choice":{"type":"tool","name":'),
        text(F.col("schema_name")),
        F.lit("}}"),
    )


def call_outcome(status: Column, tries: Column, most_tries: int = 3) -> Column:
    """answered, again, unavailable or failed: after ``most_tries`` what is worth another try counts as unavailable."""
    return (
        F.when(status.between(200, 299), "answered")
        .when(status.isin(*REFUSED), "unavailable")
        .when(status.isin(*AGAIN), F.when(tries < most_tries, "again").otherwise("unavailable"))
        .otherwise("failed")
    )


def usage(calls: DataFrame, *by: str, prices: tuple[float, float] = (3.0, 15.0), read_share: float = 0.1, write_share: float = 1.25) -> DataFrame:
    """Calls and tokens by the columns ``by``: calls, input, output, cache_read, cache_creation, hit_ratio, cost.

    ``calls`` has a ``usage`` struct of input_tokens, output_tokens,
    cache_read_input_tokens and cache_creation_input_tokens; missing ones are 0.
    ``hit_ratio`` is the cached share of all that was read (null where nothing
    was). ``prices`` are for a million tokens of input and output; what is read from
    the cache costs ``read_share`` of input, what is written to it ``write_share``.
    """
    fields = {"input": "input_tokens", "output": "output_tokens", "cache_read": "cache_read_input_tokens", "cache_creation": "cache_creation_input_tokens"}
    sums = calls.groupBy(*by).agg(F.count(F.lit(1)).alias("calls"), *(F.sum(F.coalesce(F.col(f"usage.{f}").cast("long"), F.lit(0))).alias(n) for n, f in fields.items()))
    read = F.col("input") + F.col("cache_read") + F.col("cache_creation")
    cost = (F.col("input") + F.col("cache_read") * read_share + F.col("cache_creation") * write_share) * prices[0] + F.col("output") * prices[1]
    return sums.withColumn("hit_ratio", F.when(read > 0, F.col("cache_read") / read)).withColumn("cost", cost / 1_000_000)
