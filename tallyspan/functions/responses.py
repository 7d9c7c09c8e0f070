"""Reading polymorphic gateway responses with variant expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspan.functions.columns import bound

_USAGE = "struct<usage:struct<prompt_tokens:string,completion_tokens:string,total_tokens:string>>"


def json_usage(body: Column) -> Column:
    """``struct<input, output, total>`` of token counts, null where absent or malformed.

    One pass over the body with a schema of only these three fields, instead of
    one JSON path evaluation per field.
    """
    usage = F.from_json(body, _USAGE)["usage"]
    return F.struct(
        usage["prompt_tokens"].try_cast("bigint").alias("input"),
        usage["completion_tokens"].try_cast("bigint").alias("output"),
        usage["total_tokens"].try_cast("bigint").alias("total"),
    )


def parse_body(body: Column) -> Column:
    """JSON text -> variant; malformed text becomes null."""
    return F.try_parse_json(body)


def _shape(value: Column) -> Column:
    return F.schema_of_variant(value)


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _is_list(value: Column) -> Column:
    return _shape(value).startswith("ARRAY")


def _is_object(value: Column) -> Column:
    return _shape(value).startswith("OBJECT")


def normalize_content(content: Column) -> Column:
    """Message content of any provider as one plain string.

    Nothing -> ``''``; a string stays; a list joins the text of its blocks with
    no separator, a block that is not an object counting as its own text; any
    other value becomes its string form.
    """
    def block_text(block: Column) -> Column:
        own = F.when(
            _is_object(block), F.try_variant_get(block, "$.text", "string")
        ).otherwise(_text(block))
        return F.coalesce(own, F.lit(""))

    def flat(value: Column) -> Column:
        blocks = F.try_variant_get(value, "$", "array<variant>")
        return (
            F.when(value.isNull() | F.is_variant_null(value), F.lit(""))
            .when(_is_list(value), F.array_join(F.transform(blocks, block_text), ""))
            .otherwise(F.coalesce(_text(value), F.lit("")))
        )

    return bound(content, flat)


def message_content(body: Column) -> Column:
    """The first choice's message content, as a variant."""
    return F.try_variant_get(body, "$.choices[0].message.content", "variant")


_POLICY = "struct<name:string,action:string,phase:string,reason:string>"


def policy_key(body_text: Column, suffix: str = "service_policy") -> Column:
    """Name of the top-level verdict field; gateways put their own prefix before it."""
    keys = F.filter(F.json_object_keys(body_text), lambda k: k.endswith(suffix))
    return F.get(keys, F.lit(0))


def policy_block(body_text: Column, suffix: str = "service_policy") -> Column:
    """Verdict of the policy that denied a request, or null if none did.

    A denial is HTTP 200 with a verdict object whose action is ``deny``. A
    filtered response without that object still counts, under ``unknown``.
    Bodies naming neither are answered by two substring tests, unparsed.
    """
    path = F.concat(F.lit("$."), policy_key(body_text, suffix))
    found = F.from_json(F.call_function("get_json_object", body_text, path), _POLICY)
    finish = F.get_json_object(body_text, "$.choices[0].finish_reason")
    unknown = F.struct(
        F.lit("unknown").alias("name"),
        F.lit("deny").alias("action"),
        F.lit(None).cast("string").alias("phase"),
        F.lit(None).cast("string").alias("reason"),
    )

    def judged(verdict: Column) -> Column:
        return F.when(verdict["action"] == "deny", verdict).when(
            finish == "content_filter", unknown
        )

    suspect = body_text.contains(suffix) | body_text.contains("content_filter")
    return F.when(suspect, bound(found, judged))


def extract_answer(body: Column) -> Column:
    """Text of the last assistant message that has any.

    List content joins its ``output_text`` parts with newlines, string content
    stays; failing both, the first choice's content; failing that, the body.
    """
    messages = F.try_variant_get(body, "$.output", "array<variant>")

    def answer(message: Column) -> Column:
        content = F.try_variant_get(message, "$.content", "variant")
        parts = F.filter(
            F.try_variant_get(content, "$", "array<variant>"),
            lambda c: (F.try_variant_get(c, "$.type", "string") == "output_text")
            & (F.coalesce(F.try_variant_get(c, "$.text", "string"), F.lit("")) != ""),
        )
        joined = F.array_join(
            F.transform(parts, lambda c: F.try_variant_get(c, "$.text", "string")), "\n"
        )
        text = F.when(_is_list(content), F.when(F.size(parts) > 0, joined)).when(
            _shape(content) == "STRING", F.nullif(_text(content), F.lit(""))
        )
        return F.when(F.try_variant_get(message, "$.role", "string") == "assistant", text)

    answers = F.filter(F.transform(messages, answer), lambda a: a.isNotNull())
    choice = F.try_variant_get(body, "$.choices[0].message.content", "string")
    return F.coalesce(F.get(answers, F.size(answers) - 1), choice, F.to_json(body))


def outcome(status: Column, policy: Column) -> Column:
    """Scenario rule: any status but 200, or a denying policy, is ``blocked``."""
    return F.when((status != 200) | policy.isNotNull(), "blocked").otherwise("allowed")


def burst_outcome(status: Column, policy: Column) -> Column:
    """Burst rule: keeps rate-limit rejections and errors apart from denials."""
    return (
        F.when((status == 200) & policy.isNotNull(), "blocked")
        .when(status == 200, "allowed")
        .when(status == 429, "rate_limited")
        .otherwise("error")
    )


def format_results(answer: Column, results: Column, n: int = 3, width: int = 300) -> Column:
    """Search results as text: a summary, then the first ``n`` hits, blank lines between."""
    hits = F.transform(
        F.slice(F.coalesce(results, F.array().cast(
            "array<struct<title:string,url:string,content:string>>")), 1, n),
        lambda r: F.concat(
            F.lit("- ["), r["title"], F.lit("]("), r["url"], F.lit(")\n  "),
            F.substring(r["content"], 1, width),
        ),
    )
    summary = F.when(
        F.coalesce(answer, F.lit("")) != "", F.array(F.concat(F.lit("Summary: "), answer))
    ).otherwise(F.array().cast("array<string>"))
    text = F.array_join(F.concat(summary, hits), "\n\n")
    return F.when(text == "", "No results found.").otherwise(text)


def preview(text: Column, width: int) -> Column:
    """Cut to ``width`` characters with an ellipsis, only where the text is longer."""
    return F.when(
        F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))
    ).otherwise(text)
