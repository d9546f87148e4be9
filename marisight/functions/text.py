"""Text functions of chat, catalogue and listing data, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: words that mark a Malay question
MALAY_HINTS = ("apa", "apakah", "bagaimana", "bantuan", "dasar", "kerajaan", "pelajar", "untuk", "boleh", "adakah", "syarat", "permohonan", "keluarga", "pekerja")
#: fixed values: openings too broad to answer
BROAD_OPENINGS = ("tell me about", "overview of", "explain policy", "ceritakan tentang")


def collapsed(text: Column) -> Column:
    """White space as single spaces, trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def question_language(text: Column) -> Column:
    """'ms' with two Malay hints or more (repeats count), else 'en'."""
    hints = F.array(*[F.lit(h) for h in MALAY_HINTS])
    words = tokens(F.replace(F.lower(text), F.lit("?"), F.lit(" ")))
    return F.when(F.size(F.filter(words, lambda t: F.array_contains(hints, t))) >= 2, "ms").otherwise("en")


def needs_clarification(text: Column) -> Column:
    """One word or less, or one of the broad openings."""
    s = collapsed(F.lower(text))
    out = F.size(tokens(s)) <= 1
    for opening in BROAD_OPENINGS:
        out = out | s.startswith(opening)
    return out


def conversation_title(text: Column, most: int = 80) -> Column:
    return F.substring(collapsed(text), 1, most)


def short_title(title: Column) -> Column:
    """Without a long leading hex mark; 47 characters and dots if longer than 50; the raw title if empty."""
    s = F.regexp_replace(title, "^[0-9a-fA-F]{32,}[_ -]*", "")
    s = F.when(F.trim(s) == "", title).otherwise(s)
    return F.when(F.length(s) > 50, F.concat(F.substring(s, 1, 47), F.lit("..."))).otherwise(s)


def percent_decoded(text: Column) -> Column:
    """Blank-led hex pairs read as percent escapes; the raw text if that fails."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(text, " ([0-9A-Fa-f]{2})", "%$1")), text)


def initials(email: Column) -> Column:
    """Upper-case first letters of the first two parts of a mail name."""
    parts = F.filter(F.split(F.split_part(email, F.lit("@"), F.lit(1)), r"[._\-]"), lambda p: p != "")
    return F.upper(F.array_join(F.transform(F.slice(parts, 1, 2), lambda p: F.substring(p, 1, 1)), ""))


def word_chunks(text: Column, size: int = 8) -> Column:
    """Groups of ``size`` words; all but the last end in a space."""
    words = F.split(text, " ")
    n = F.ceil(F.size(words) / size).cast("int")
    groups = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array_join(F.slice(words, i * size + 1, size), " "))
    return F.transform(groups, lambda g, i: F.when(i < n - 1, F.concat(g, F.lit(" "))).otherwise(g))


def linked_answer(text: Column, live_index: Column) -> Column:
    """An answer as it is shown: ``[n]`` marks as ``cite:n`` code, ``[General knowledge]`` gone, mentions of the open-data
    site as its citation, where ``live_index`` has one; without one only its bracketed mentions go."""
    # fixed values: the marks of answers and what they become
    said = F.regexp_replace(F.regexp_replace(text, r"\[(\d+)\]", "`cite:$1`"), r"(?i)\[General knowledge\]", "")
    mark = F.concat(F.lit("`cite:"), live_index.cast("string"), F.lit("`"))
    bracketed = F.regexp_replace(said, F.lit(r"(?i)\[data\.gov\.my\]"), F.coalesce(mark, F.lit("")))
    return F.when(live_index.isNull(), bracketed).otherwise(F.regexp_replace(bracketed, F.lit(r"(?<!`cite:)\bdata\.gov\.my\b(?![`\]])"), mark))


def citation_marks(text: Column) -> Column:
    """Numbers of the [n] marks of an answer, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"\[(\d+)\]"), 1), lambda x: x.cast("int"))


#: fixed values: what some sites put before every title, and what stands before a site's name in titles
TITLE_PREFIXES = ("kpm | ", "kementerian pendidikan malaysia | ")
TITLE_MARKS = (" | ", " - ", " – ")


def without_prefix(title: Column) -> Column:
    """A title without the first known prefix that it begins with."""
    out = title
    for prefix in reversed(TITLE_PREFIXES):
        out = F.when(F.lower(title).startswith(prefix), F.substring(title, len(prefix) + 1, F.length(title))).otherwise(out)
    return out


def listing_title(title: Column) -> Column:
    """The part before the site's name, behind the first of the marks that the title has."""
    out = title
    for mark in reversed(TITLE_MARKS):
        out = F.when(F.contains(title, F.lit(mark)), F.trim(F.split_part(title, F.lit(mark), F.lit(1)))).otherwise(out)
    return out


def date_and_title(text: Column) -> Column:
    """(date, title) of a cell that holds a date line and a title line."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    dated = lambda x: x.rlike(r"^\d{1,2}\s+\p{L}+\s+\d{4}$")
    return F.struct(F.coalesce(F.try_element_at(F.filter(lines, dated), F.lit(1)), F.lit("")).alias("date"), F.array_join(F.filter(lines, lambda x: ~dated(x)), " ").alias("title"))


#: fixed values: kinds of publications and the words that tell them, first rule first
DOCUMENT_KINDS = {
    "press_release": ("kenyataan media", "press release", "media release"),
    "statement": ("surat siaran", "statement", "siaran"),
    "report": ("laporan", "report"),
    "notice": ("pekeliling", "circular", "pengumuman", "notice", "iklan", "arahan"),
    "speech": ("ucapan", "speech"),
}


def document_kind(url: Column, title: Column, fallback: str = "other") -> Column:
    """Kind of a publication by key words anywhere in address and title, first rule first."""
    said = F.lower(F.concat_ws(" ", F.coalesce(url, F.lit("")), F.coalesce(title, F.lit(""))))
    out = F.lit(fallback)
    for kind, words in reversed(DOCUMENT_KINDS.items()):
        out = F.when(F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(said, w)), kind).otherwise(out)
    return out


def language_code(code: Column) -> Column:
    """'my' is written for Malay in places; the code is 'ms'."""
    return F.when(F.lower(code) == "my", "ms").otherwise(F.lower(code))


def vector_literal(vector: Column) -> Column:
    """[a,b,…] with up to twelve significant digits, no zeros behind the last one."""

    def number(x: Column) -> Column:
        whole = F.format_string("%.12g", x.cast("double"))
        return F.regexp_replace(F.regexp_replace(whole, r"(\.\d*?)0+(e|$)", "$1$2"), r"\.(e|$)", "$1")

    return F.concat(F.lit("["), F.array_join(F.transform(vector, number), ","), F.lit("]"))


def clamped_limit(limit: Column, default: int = 10, most: int = 100) -> Column:
    return F.least(F.coalesce(limit, F.lit(default)), F.lit(most))


def unknown_dataset(dataset_id: Column, known: Column) -> Column:
    """What a tool answers to an id that isn't in the catalogue; null for one that is."""
    asked = F.coalesce(dataset_id, F.lit(""))
    # fixed values: the answer's wording
    said = F.concat(F.lit("Unknown dataset: "), asked, F.lit(". Available: "), F.array_join(known, ", "))
    return F.when(~F.array_contains(known, asked), said)


def merged_map(a: Column, b: Column) -> Column:
    """Entries of both maps; b's where both have a key."""
    return F.map_concat(F.map_filter(a, lambda k, v: ~F.array_contains(F.map_keys(b), k)), b)


def sorted_json(m: Column) -> Column:
    """A map as JSON with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))
