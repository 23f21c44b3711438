"""Documents put together from pages: flags, structured text, direction, glossary, parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veilspan.functions import blocks
from veilspan.functions.text import count_of, fold_turkish, let, literal_array, strip

#: Fixed values.
LANGUAGES = {"en>tr": ("English", "Turkish"), "tr>en": ("Turkish", "English")}
REQUIRED_FIELDS = ("translator_full_name", "ata_member_number", "source_language", "target_language", "page_count", "date", "state_name", "city")
SECTIONS = ("Translated Document", "Certification of Accuracy", "Source Document")
TURKISH = "ğĞıİşŞ"
MAGIC = {"25504446": "pdf", "89504E47": "image", "FFD8FF": "image"}
#: Rules of the prompt for a translator.
PROMPT_RULES = (
    "Give Markdown only: # for the title, ## for sections, a blank line between paragraphs, pipe tables.",
    "Keep tokens like [PERSON_1] as they are; they may move within their sentence.",
    "Keep numbers of cases, accounts, sections and clauses as they are.",
    f"Where a table can't be read with certainty, write {blocks.REVIEW_MARKER} on a line of its own and give its text as lines.",
    "Write [ILLEGIBLE] for what can't be read.",
)
#: Share of letters that are Turkish only from which a text is taken for Turkish.
TURKISH_FROM = 0.005


def documents(pages: DataFrame, doc: list[str]) -> DataFrame:
    """page_count, has_integrity_flags and flagged_pages from restored pages: flagged if a placeholder is missing or a token unresolved."""
    bad = (F.size("missing_placeholders") + F.size("unresolved_tokens")) > 0
    return pages.groupBy(*doc).agg(
        F.count(F.lit(1)).alias("page_count"),
        F.bool_or(bad).alias("has_integrity_flags"),
        F.array_join(F.array_sort(F.collect_list(F.when(bad, F.col("page_index")))), ",").alias("flagged_pages"),
    )


def structured_text(lines: DataFrame, page: list[str]) -> DataFrame:
    """Lines of a paragraph (block and paragraph number of line_id) joined by a space, paragraphs by a blank line, in the order they are first seen."""
    par = F.substring_index("line_id", ":", 2)
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_seq", "text"))), lambda x: x["text"]), " ")
    pars = lines.withColumn("par", par).groupBy(*page, "par").agg(F.min("line_seq").alias("at"), ordered.alias("text"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "\n\n")
    return pars.groupBy(*page).agg(whole.alias("structured"), F.count(F.lit(1)).alias("n_paragraphs"))


def direction(text: Column) -> Column:
    """tr>en for a text with enough letters that only Turkish has, else en>tr; those that French or German share don't count."""
    t = F.coalesce(text, F.lit(""))
    own = F.length(t) - F.length(F.translate(t, TURKISH, ""))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]", ""))
    return F.when(own > F.lit(TURKISH_FROM) * letters, "tr>en").otherwise("en>tr")


def languages(direction_: Column) -> Column:
    """source and target; any other direction is an error."""
    out = F.raise_error(F.concat(F.lit("unknown direction: "), F.coalesce(direction_, F.lit("null")))).cast("struct<source:string,target:string>")
    for d, (a, b) in LANGUAGES.items():
        out = F.when(direction_ == d, F.struct(F.lit(a).alias("source"), F.lit(b).alias("target"))).otherwise(out)
    return out


def glossary_upsert(glossary: DataFrame, candidates: DataFrame) -> DataFrame:
    """glossary and candidates: term, translation; glossary also verified. Terms are equal when their Turkish folds are. A verified term never changes; another takes the candidate's translation, a new one is added unverified. Of candidates with one fold the smallest (term, translation) counts."""
    key = fold_turkish(strip(F.col("term")))
    new = candidates.withColumn("fold", key).groupBy("fold").agg(F.min(F.struct("term", "translation")).alias("c")).select("fold", "c.*")
    old = glossary.withColumn("fold", key)
    kept = old.where("verified")
    open_ = old.where("not verified")
    free = new.join(kept, "fold", "left_anti")
    untouched = open_.join(free, "fold", "left_anti")
    written = free.withColumn("verified", F.lit(False))
    return kept.select("fold", "term", "translation", "verified").unionByName(untouched.select("fold", "term", "translation", "verified")).unionByName(written.select("fold", "term", "translation", "verified"))


def bookmarks(parts: DataFrame, doc: list[str]) -> DataFrame:
    """Adds first_page: the pages of the parts before, from 0. parts: doc, part, label, pages; a null label is an error."""
    before = Window.partitionBy(*doc).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    label = F.when(F.col("label").isNull(), F.raise_error(F.lit("a part has no label")).cast("string")).otherwise(F.col("label"))
    return parts.withColumn("label", label).withColumn("first_page", F.coalesce(F.sum("pages").over(before), F.lit(0)).cast("long"))


def blank_fields(values: Column, required: tuple[str, ...] = REQUIRED_FIELDS) -> Column:
    """Required fields of a map of texts that are missing or empty; "0" isn't."""
    return F.filter(literal_array(required), lambda k: F.coalesce(F.try_element_at(values, k), F.lit("")) == "")


def required(values: Column, required_: tuple[str, ...] = REQUIRED_FIELDS) -> Column:
    """The map of texts, or an error that names the required fields that are blank."""
    return let(blank_fields(values, required_), lambda b: F.when(F.size(b) > 0, F.raise_error(F.concat(F.lit("blank fields: "), F.array_join(b, ", "))).cast("map<string,string>")).otherwise(values))


def page_counts(pages: DataFrame, doc: list[str]) -> DataFrame:
    """n_pages of each document."""
    return pages.groupBy(*doc).agg(F.count(F.lit(1)).alias("n_pages"))


def pages_at(pages: DataFrame, wanted: DataFrame, doc: list[str]) -> DataFrame:
    """The pages that ``wanted`` (doc, page_index) names; an index below 0, or not below the number of the document's pages, is an error."""
    asked = wanted.join(page_counts(pages, doc), doc, "left")
    n = F.coalesce("n_pages", F.lit(0))
    inside = (F.col("page_index") >= 0) & (F.col("page_index") < n)
    wrong = F.raise_error(F.concat(F.lit("page "), F.col("page_index").cast("string"), F.lit(" of "), n.cast("string"))).cast("int")
    return asked.withColumn("page_index", F.when(inside, F.col("page_index")).otherwise(wrong)).drop("n_pages").join(pages, [*doc, "page_index"])


def readable_parts(parts: DataFrame) -> DataFrame:
    """Parts of a package (label, pages); one that is missing (null pages) or has no pages is an error."""
    bad = F.col("pages").isNull() | (F.col("pages") < 1)
    return parts.withColumn("pages", F.when(bad, F.raise_error(F.concat(F.col("label"), F.lit(" can't be read or is empty"))).cast("long")).otherwise(F.col("pages").cast("long")))


def package(jobs: DataFrame, doc: list[str]) -> DataFrame:
    """The parts of each package in order, a row for each: part, label, pages, first_page (from 0), and the values of its certificate.

    jobs: doc, translated_pages, certificate_pages, source_pages, direction, date and profile
    (a map of texts). The certificate names the languages of the direction and the pages of
    the approved translation. An unknown direction, a blank value, and a part without pages
    are errors, so that no package comes out incomplete.
    """
    both = languages(F.col("direction"))
    more = F.create_map(F.lit("source_language"), both["source"], F.lit("target_language"), both["target"], F.lit("page_count"), F.col("translated_pages").cast("string"), F.lit("date"), F.col("date").cast("string"))
    own = F.map_filter("profile", lambda k, _: ~k.isin("source_language", "target_language", "page_count", "date"))
    filled = jobs.withColumn("certificate", required(F.map_concat(own, more)))
    counts = F.array(*[F.col(c).cast("long") for c in ("translated_pages", "certificate_pages", "source_pages")])
    rows = filled.select(*doc, "certificate", F.posexplode(F.arrays_zip(literal_array(SECTIONS).alias("label"), counts.alias("pages"))).alias("part", "p")).select(*doc, "certificate", "part", "p.label", "p.pages")
    return bookmarks(readable_parts(rows), doc).select(*doc, "part", "label", "pages", "first_page", F.map_from_entries(F.array_sort(F.map_entries("certificate"))).alias("certificate"))


def sniffed(content: Column) -> Column:
    """pdf or image by the leading bytes; an empty or any other content is an error."""
    head = F.hex(F.substring(content, 1, 8))
    out = F.raise_error(F.lit("unsupported content")).cast("string")
    for magic, kind in MAGIC.items():
        out = F.when(head.startswith(magic), kind).otherwise(out)
    return out


def line_parity(text: Column, n_lines: Column) -> Column:
    """A text has as many lines as expected."""
    return F.size(F.split(text, "\n")) == n_lines


def line_pairs(pages: DataFrame, lines: DataFrame, page: list[str]) -> DataFrame:
    """Lines of a page's text beside the recognised ones, by place: page, line_no, line_id, original, anonymized. A page whose numbers of lines differ has none. lines: page, line_seq, line_id, text."""
    own = lines.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("line_seq", "line_id", F.col("text").alias("original")))).alias("own"))
    both = pages.join(own, page).where(line_parity(F.col("text"), F.size("own")))
    pairs = F.arrays_zip(F.split("text", "\n").alias("anonymized"), F.col("own").alias("line"))
    return both.select(*page, F.posexplode_outer(pairs).alias("line_no", "p")).where("p is not null").select(*page, "line_no", "p.line.line_id", "p.line.original", "p.anonymized")


def survival(rows: DataFrame, by: list[str]) -> DataFrame:
    """Presence checks of tokens by format: rows with text and token."""
    ok = F.contains("text", F.col("token")).cast("int")
    return rows.groupBy(*by).agg(F.sum(ok).cast("long").alias("survived"), F.count(F.lit(1)).alias("total"), F.avg(ok).alias("rate"))


def occurrences(template: Column, slot: Column) -> Column:
    """How often a slot ``{name}`` stands in a template."""
    return count_of(template, F.concat(F.lit("{"), slot, F.lit("}")))


def rendered(template: Column, slots: Column) -> Column:
    """Template with each ``{name}`` of an array of struct(name, token) replaced."""
    return F.aggregate(slots, template, lambda a, s: F.replace(a, F.concat(F.lit("{"), s["name"], F.lit("}")), s["token"]))


def expected_tokens(template: Column, slots: Column) -> Column:
    """What a text made from the template must have: each slot's token once for each time that the slot stands in it."""
    return F.flatten(F.transform(slots, lambda s: F.array_repeat(s["token"], occurrences(template, s["name"]))))


def failed_cases(rows: DataFrame, by: list[str], cases: Column) -> DataFrame:
    """For each format the cases of a list that lost a token, sorted. rows: by, case_id, text, token."""
    lost = F.collect_set(F.when(~F.contains("text", F.col("token")), F.col("case_id")))
    return rows.groupBy(*by).agg(lost.alias("lost")).select(*by, F.array_sort(F.array_intersect("lost", cases)).alias("failed"))


def prompt(text: Column, direction_: Column) -> Column:
    """What a translator is asked: the languages of the direction, the rules that the steps after it count on, and the text."""
    both = languages(direction_)
    rules = "\n".join(f"- {r}" for r in PROMPT_RULES)
    return F.concat(F.lit("Translate this legal document from "), both["source"], F.lit(" into "), both["target"], F.lit(f".\n{rules}\n\n"), text)


def outcome(text: Column, marker: str, tables: Column) -> Column:
    """hatch if the marker occurs, table if any block is one, else prose."""
    return F.when(F.contains(text, F.lit(marker)), "hatch").when(tables, "table").otherwise("prose")


def side(row: Column, petitioner: tuple[str, ...], respondent: tuple[str, ...]) -> Column:
    """Which side a signature row speaks of."""
    r = F.lower(row)

    def any_of(words: tuple[str, ...]) -> Column:
        found = F.lit(False)
        for w in words:
            found = found | F.contains(r, F.lit(w))
        return found

    p, q = any_of(petitioner), any_of(respondent)
    return F.when(p & ~q, "petitioner").when(q & ~p, "respondent").otherwise("unclear")


def attribution(text: Column, first: str, second: str, petitioner: tuple[str, ...], respondent: tuple[str, ...]) -> Column:
    """correct if the first row with ``first`` is the petitioner's and that with ``second`` the respondent's, incorrect the other way round, else ambiguous."""
    rows = F.filter(F.split(text, "\n"), lambda x: strip(x) != "")

    def of(token: str) -> Column:
        return F.try_element_at(F.filter(rows, lambda x: F.contains(x, F.lit(token))), F.lit(1))

    a, b = (side(of(t), petitioner, respondent) for t in (first, second))
    lost = of(first).isNull() | of(second).isNull()
    return F.when(lost, "ambiguous").when((a == "petitioner") & (b == "respondent"), "correct").when((a == "respondent") & (b == "petitioner"), "incorrect").otherwise("ambiguous")


def table_score(text: Column, marker: str, sentinel: str) -> Column:
    """What a translator made of a table: n_rows (pipe rows), n_separators, col_counts of the other rows, whether the review marker fired and whether the hint leaked."""
    rows = F.transform(F.filter(F.split(text, "\n"), blocks.is_pipe_row), strip)
    data = F.filter(rows, lambda r: ~blocks.is_separator(r))
    return F.struct(
        F.size(rows).alias("n_rows"), F.size(F.filter(rows, blocks.is_separator)).alias("n_separators"), F.transform(data, lambda r: F.size(blocks.cells(r))).alias("col_counts"),
        F.contains(text, F.lit(marker)).alias("hatch_fired"), F.contains(text, F.lit(sentinel)).alias("hint_leaked"),
    )


def retry_seconds(message: Column) -> Column:
    """Seconds that a service asks to wait, null where it says none."""
    return F.regexp_extract(message, r"(?i)retry in ([0-9.]+)s", 1).try_cast("double")


def labelled_parts(sources: Column, labels: Column) -> Column:
    """Sources with their labels, by position. Labels may be null for three sources only, which have fixed ones; other numbers of labels than of sources are an error."""
    own = F.when(labels.isNull() & (F.size(sources) == len(SECTIONS)), literal_array(SECTIONS)).otherwise(labels)
    zipped = F.arrays_zip(sources.alias("source"), own.alias("label"))
    bad = F.raise_error(F.lit("labels and sources differ in number")).cast("array<struct<source:string,label:string>>")
    return F.when(own.isNotNull() & (F.size(own) == F.size(sources)), zipped).otherwise(bad)
