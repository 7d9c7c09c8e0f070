"""Rule tables and the column expressions that apply them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# No letter, digit or underscore right before / right after. Spelled out because
# the reach of ``\b`` beyond ASCII differs between Java versions.
_START, _END = r"(?<![0-9A-Za-z_])", r"(?![0-9A-Za-z_])"

# Shapes of personal data.
PII_PATTERNS = {
    "ssn": _START + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _END,
    "credit_card": _START + r"[0-9](?:[ -]?[0-9]){12,15}" + _END,
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": (
        r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}" + _END
        + "|" + _START + r"[0-9]{3}-[0-9]{3}-[0-9]{4}" + _END
    ),
}

# How each kind is named in a reason.
PII_NAMES = {
    "ssn": "a social security number",
    "credit_card": "a credit card number",
    "email": "an email address",
    "phone": "a phone number",
}

# A character every match of the kind holds.
_MARKS = {"ssn": "-", "email": "@", "phone": "-"}


def may_hold(text: Column, kind: str) -> Column:
    """A cheap test that a text could hold the kind, made before its pattern is run."""
    return text.contains(_MARKS[kind]) if kind in _MARKS else text.rlike("[0-9]")


# Wordings of instruction override, jailbreak, prompt leaking and malware requests: an act, and
# within a few words what it is aimed at.
INJECTION_RULES = [
    ("override", r"\b(ignore|disregard|forget|override|bypass)\b.{0,40}"
                 r"\b(instructions?|rules|guidelines|prompts?|polic(y|ies))\b"),
    ("jailbreak", r"\b(you are|act as|pretend to be)\b.{0,60}"
                  r"\b(anything|unrestricted|unfiltered|no (limits|restrictions|rules))\b"),
    ("jailbreak", r"\b(developer|god) mode\b|\bwithout (any )?(restrictions|limits|refus[a-z]+)\b"),
    ("prompt_leak", r"\b(print|reveal|show|repeat|output|tell)\b.{0,40}"
                    r"\b(system|hidden|initial) (prompt|message|instructions)\b"),
    ("malware", r"\b(write|create|build|make)\b.{0,40}"
                r"\b(malware|ransomware|keyloggers?|virus|trojan)\b"),
]

# Wordings of hate, threats and incitement: general ones, one feature among others of the classifier
# that judges unsafe content (``operators.classifiers``).
UNSAFE_RULES = [
    ("hate", r"\b(racist|hateful|bigot(ed)?|slurs?|subhuman|inferior race)\b"),
    ("violence", r"\b(tortur[a-z]*|massacre|behead[a-z]*|graphic violence)\b"),
    ("threat", r"\b(i|we)('ll| will| am going to| are going to) (kill|hurt|hunt|beat|destroy) (you|them)\b"),
    ("self_harm", r"\b(kill|hang|hurt) (yourself|yourselves)\b"),
    ("insult", r"\byou('re| are)( all)? (an? |such an? )?(complete |utter |absolute )?"
               r"(idiots?|fools?|cretins?|imbeciles?|disgrace)\b"),
]

# How a model words a refusal.
REFUSAL = r"i (can't|cannot|won't|am unable to|'m unable to|'m not able to)|i'm sorry, but"


def whole_word(options: str) -> str:
    """A pattern for one of ``a|b|c`` standing alone between non-letters and non-digits."""
    return rf"(^|[^\p{{L}}\p{{N}}])({options})($|[^\p{{L}}\p{{N}}])"


def standing_alone(value: Column) -> Column:
    """A pattern for a literal value (digits, spaces, hyphens) that is not part of a longer run."""
    return F.concat(F.lit(_START), value, F.lit(_END))


def words(text: Column) -> Column:
    """Lower-case words: everything between characters that are neither letter nor digit."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def pii_values(text: Column, kind: str) -> Column:
    """All values of one kind in the whole text; card numbers must pass the Luhn check."""
    found = F.regexp_extract_all(text, F.lit(PII_PATTERNS[kind]), F.lit(0))
    if kind == "credit_card":
        found = F.filter(
            found, lambda v: F.call_function("luhn_check", F.regexp_replace(v, "[ -]", ""))
        )
    return F.when(may_hold(text, kind), found).otherwise(F.array().cast("array<string>"))


def pii_array_sql(text: str) -> str:
    """SQL of ``pii_array`` for the column or parameter named ``text``."""
    named = []
    for kind, pattern in PII_PATTERNS.items():
        found = f"regexp_extract_all({text}, r'{pattern}', 0)"
        if kind == "credit_card":
            found = f"filter({found}, v -> luhn_check(regexp_replace(v, '[ -]', '')))"
        named.append(f"transform({found}, v -> named_struct('kind', '{kind}', 'value', v))")
    return f"concat({', '.join(named)})"


def pii_array(text: Column) -> Column:
    """``array<struct<kind, value>>`` of every finding, kinds in the order above."""
    def named(kind: str) -> Column:
        return F.transform(
            pii_values(text, kind),
            lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")),
        )

    return F.concat(*[named(kind) for kind in PII_PATTERNS])


def first_pii(text: Column) -> Column:
    """The first finding only: kinds are tried in turn and the rest is not searched."""
    def lead(kind: str) -> Column:
        found = F.slice(pii_values(text, kind), 1, 1)
        return F.get(
            F.transform(found, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))),
            F.lit(0),
        )

    return F.coalesce(*[lead(kind) for kind in PII_PATTERNS])


def matching_rules(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Names of the rules a text hits, in rule order, without repeats."""
    low = F.lower(text)
    hits = [F.when(low.rlike(pattern), F.lit(name)) for name, pattern in rules]
    return F.array_distinct(F.array_compact(F.array(*hits)))


def any_rule(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    return F.lower(text).rlike("|".join(f"(?:{pattern})" for _, pattern in rules))


def deny(name: str, phase: str, reason: Column, when: Column) -> Column:
    """A verdict struct where ``when`` holds, else null."""
    return F.when(
        when,
        F.struct(
            F.lit(name).alias("name"), F.lit("deny").alias("action"),
            F.lit(phase).alias("phase"), reason.alias("reason"),
        ),
    )


def first_label(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first rule that matches, in priority order."""
    low = F.lower(text)
    return F.coalesce(*[F.when(low.rlike(p), F.lit(name)) for name, p in rules], F.lit(default))


def route(text: Column, data_rules: Sequence[str], document_rules: Sequence[str]) -> Column:
    """``data``, ``docs`` or ``both``; a question hitting neither goes to the documents."""
    low = F.lower(text)
    data = low.rlike("|".join(f"(?:{p})" for p in data_rules))
    docs = low.rlike("|".join(f"(?:{p})" for p in document_rules))
    return F.when(data, F.when(docs, "both").otherwise("data")).otherwise("docs")
