"""Text expressions that stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Distinct lower-case runs of a-z, 0-9 and the apostrophe."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9']+)"), 1))


def style_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z']+)"), 1)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def cosine(a: Column, b: Column) -> Column:
    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)

    dot = total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    norm = F.sqrt(total(F.transform(a, lambda x: x.cast("double") * x.cast("double")))) * F.sqrt(total(F.transform(b, lambda x: x.cast("double") * x.cast("double"))))
    return F.when(norm > 0, dot / norm).otherwise(F.lit(0.0))


def ngrams(words: Column, n: int = 4) -> Column:
    """Distinct runs of n words, joined by blanks."""

    def runs(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - n + 1)
        return F.when(F.size(w) >= n, F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " ")))).otherwise(F.array().cast("array<string>"))

    # The outer transform binds the words once; written out, they would be extracted anew for every run.
    return F.element_at(F.transform(F.array(words), runs), 1)


def cue_pattern(term: str) -> str:
    """A term as a whole word or phrase, in any case, with any white space between its words."""
    return r"(?iU)\b" + r"\s+".join(re.escape(w) for w in term.split()) + r"\b"


def cue_hits(text: Column, terms: list[str]) -> Column:
    """The terms that occur, in the order given; blank terms never do."""
    given = [t for t in terms if t.strip()]
    if not given:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*(F.when(text.rlike(cue_pattern(t)), F.lit(t)) for t in given)))


def short_id(prefix: str, *parts: Column) -> Column:
    joined = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(joined, 256), 1, 10))


def structural_key(*parts: Column) -> Column:
    return F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def keeps_share(key: Column, share: float) -> Column:
    """A fixed sample: the first 8 hex digits of the key's sha256, modulo 1000, under the share."""
    if share >= 1:
        return F.lit(True)
    if share <= 0:
        return F.lit(False)
    return F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 8), 16, 10).cast("long") % 1000 / 1000 < share


#: Fixed value: a template slot that a writer left unfilled.
SLOT = r"\[([^\[\]\n]{1,60})\]"


def placeholders(text: Column, known: list[str] | None = None) -> Column:
    """Bracketed runs of 1 to 60 characters with a letter and no digit, other than known passage ids in any case."""
    found = F.transform(F.regexp_extract_all(text, F.lit(SLOT), 1), lambda x: F.trim(x))
    ids = [k.lower() for k in known or []]
    fits = F.filter(found, lambda x: x.rlike(r"\p{L}") & ~x.rlike(r"\p{Nd}") & (~F.lower(x).isin(ids) if ids else F.lit(True)))
    return F.array_distinct(fits)


def tidy_phrase(text: Column) -> Column:
    """One line without a full stop; an ordinary capital at its start becomes small, those of I or an acronym stay."""
    flat = F.regexp_replace(collapsed(text), r"[. ]+$", "")
    return F.when(F.substring(flat, 1, 2).rlike(r"^\p{Lu}[^\p{Ll}]*$"), flat).otherwise(F.concat(F.lower(F.substring(flat, 1, 1)), F.substr(flat, F.lit(2))))


#: The words of grading notes, and the most notes a grading key holds.
PASS_NOTE, FAIL_VERB, FAIL_ENDS, FAIL_SHOWS = "PASS if the reply ", "FAIL if the reply ", "FAIL if the reply ends up ", "FAIL if the reply shows "
MOST_NOTES = 12


def deciding_word(text: Column) -> Column:
    """The first word of a phrase in lower case and without marks around it; the second after a word in -ly."""
    marks = "[\"'“”‘’(),]+"
    words = F.transform(F.split(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), " "), lambda w: F.lower(F.regexp_replace(w, f"^{marks}|{marks}$", "")))
    kept = F.filter(words, lambda w: w != "")
    first = F.coalesce(F.get(kept, F.lit(0)), F.lit(""))
    return F.when(first.endswith("ly") & (F.size(kept) > 1), F.get(kept, F.lit(1))).otherwise(first)


def fail_note(phrase: Column) -> Column:
    """A sentence for a failure mode, which a spec states as a gerund, a verb or a noun; '' for a blank one."""
    tidy, head = tidy_phrase(phrase), deciding_word(tidy_phrase(phrase))
    is_verb = head.endswith("s") & ~head.endswith("ss") & (F.length(head) > 3)
    opening = F.when(head.rlike("^[a-z]+ing$"), FAIL_ENDS).when(is_verb, FAIL_VERB).otherwise(FAIL_SHOWS)
    return F.when(tidy == "", "").otherwise(F.concat(opening, tidy, F.lit(".")))


def pass_note(phrase: Column) -> Column:
    tidy = tidy_phrase(phrase)
    return F.when(tidy == "", "").otherwise(F.concat(F.lit(PASS_NOTE), tidy, F.lit(".")))


def collapsed(text: Column) -> Column:
    """A text on one line, single blanks between its words; a null as ''."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def stripped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")


def filled(template: str, values: dict[str, Column | str]) -> Column:
    """A template with its {{names}} replaced; a name without a value is an error."""
    parts, missing, at = [], [], 0
    for m in re.finditer(r"\{\{\s*(\w+)\s*\}\}", template):
        parts.append(F.lit(template[at : m.start()]))
        if m.group(1) in values:
            v = values[m.group(1)]
            parts.append(F.coalesce((v if isinstance(v, Column) else F.lit(str(v))).cast("string"), F.lit("")))
        else:
            missing.append(m.group(1))
        at = m.end()
    if missing:
        raise KeyError(f"no value for {sorted(set(missing))}")
    return F.concat(*parts, F.lit(template[at:]))


def shortened(text: Column, n: int) -> Column:
    flat = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.when(F.length(flat) > n, F.concat(F.rtrim(F.substring(flat, 1, n - 1)), F.lit("…"))).otherwise(flat)


def safe_name(text: Column) -> Column:
    return F.substring(F.regexp_replace(text, r"[^A-Za-z0-9_.-]+", "_"), 1, 60)


def redact(text: Column, secrets: list[str]) -> Column:
    for s in secrets:
        if len(s) >= 8:
            text = F.replace(text, F.lit(s), F.lit("<redacted>"))
    return text


def register(spark: SparkSession) -> None:
    """SQL functions for use from SQL text: tokens_of, jaccard_of, cosine_of, ngrams_of, cue_hits_of and loose_json."""
    spark.sql("create or replace temporary function tokens_of(t string) returns array<string> return array_distinct(regexp_extract_all(lower(t), \"([a-z0-9']+)\", 1))")
    spark.sql(
        "create or replace temporary function jaccard_of(a array<string>, b array<string>) returns double return "
        "if(size(array_union(a, b)) > 0, size(array_intersect(a, b)) / size(array_union(a, b)), 0.0D)"
    )
    spark.sql(
        "create or replace temporary function cosine_of(a array<double>, b array<double>) returns double return "
        "coalesce(try_divide(aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, v) -> s + v), "
        "sqrt(aggregate(transform(a, x -> x * x), 0D, (s, v) -> s + v)) * sqrt(aggregate(transform(b, x -> x * x), 0D, (s, v) -> s + v))), 0.0D)"
    )
    spark.sql(
        "create or replace temporary function ngrams_of(w array<string>, n int) returns array<string> return "
        "if(size(w) >= n, array_distinct(transform(sequence(1, size(w) - n + 1), i -> array_join(slice(w, i, n), ' '))), array())"
    )
    spark.sql(
        "create or replace temporary function cue_hits_of(t string, terms array<string>) returns array<string> return "
        "filter(terms, c -> trim(c) != '' and t rlike concat('(?iU)\\\\b', replace(regexp_replace(trim(c), '([^\\\\p{L}\\\\p{N}\\\\s])', '\\\\\\\\$1'), ' ', '\\\\s+'), '\\\\b'))"
    )
    from .loose_json import loose_json_udf

    spark.udf.register("loose_json", loose_json_udf())
