"""Country, gender, type and dates of an artist, read from an encyclopedia page.

Pages come with the columns of ``wikitext.page_struct``: title, text, lang, categories, infobox,
persondata, abstract. Every function returns one row per page, keyed by ``title``, for one language.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from catlink.config import GROUP, PERSON, LINK_TYPE, Catalog
from catlink.functions.text import quoted_list
from catlink.operators.evidence import text
from catlink.sources.dictionaries import US_STATES, demonyms


def _strings() -> Column:
    return F.array().cast("array<string>")


# Country ------------------------------------------------------------------------------------------

# Infobox fields that may link to a country.
COUNTRY_FIELDS = {
    "en": ("origin", "born", "birth_place"),
    "fr": ("naissance lieu", "décès lieu", "nationalité", "pays origine"),
}


def place_dictionary(countries: DataFrame) -> DataFrame:
    """(kind, lookup, name, code, rank) from country page titles ``(name, code)`` and the states of the USA.

    A country is found by its title and by the title in lower case; the former is reported first.
    """
    def variant(rank: int, lookup: Column) -> DataFrame:
        return countries.select(F.lit("country").alias("kind"), lookup.alias("lookup"), "name", "code", F.lit(rank).alias("rank"))

    states = countries.sparkSession.createDataFrame([("state", s, s, "US", 0) for s in US_STATES], "kind string, lookup string, name string, code string, rank int")
    return variant(0, F.col("name")).unionByName(variant(1, F.lower("name"))).unionByName(states)


def _link_names(source: Column) -> Column:
    """Targets of ``[[x]]``, ``[[x|…`` and ``{{x}}`` as (kind, shown, lookup, pos) structs.

    A link target is also looked up as a state by every part of it that follows a comma.
    """
    clean = F.replace(source, F.lit("_"), F.lit(" "))
    targets = F.array_distinct(F.regexp_extract_all(clean, F.lit(r"\[\[([^\[\]|]+)(?=\]\]|\|)"), F.lit(1)))
    templates = F.array_distinct(F.regexp_extract_all(clean, F.lit(r"\{\{([^{}|]+)\}\}"), F.lit(1)))

    def row(kind: str, shown: Column, lookup: Column, pos: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), shown.alias("shown"), lookup.alias("lookup"), pos.alias("pos"))

    def as_states(target: Column, pos: Column) -> Column:
        parts = F.split(target, ", ")
        ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.greatest(F.size(parts), F.lit(1))), ", "))
        return F.transform(ends, lambda end: row("state", target, end, pos))

    names = F.array_distinct(F.concat(targets, templates))
    as_countries = F.transform(names, lambda name: row("country", name, name, F.lit(0)))
    return F.concat(as_countries, F.flatten(F.transform(targets, as_states)))


def _linked_places(pages: DataFrame, places: DataFrame, lang: str) -> DataFrame:
    """(title, codes_infobox, names_infobox, codes_text, names_text)."""
    fields = [("infobox", f, F.coalesce(F.try_element_at("infobox", F.lit(f)), F.lit(""))) for f in COUNTRY_FIELDS[lang]]
    fields.append(("text", "", F.coalesce("abstract", F.lit(""))))

    def located(source: str, field: str, value: Column) -> Column:
        def row(x: Column) -> Column:
            return F.struct(F.lit(source).alias("source"), F.lit(field).alias("field"), *[x[k].alias(k) for k in ("kind", "shown", "lookup", "pos")])

        return F.transform(_link_names(value), row)

    found = F.flatten(F.array(*[located(*f) for f in fields]))
    rows = pages.select("title", F.explode(found).alias("p")).select("title", "p.*").join(places, ["kind", "lookup"])
    once = rows.groupBy("title", "source", "field", "kind", "name").agg(F.min(F.struct("rank", "pos", "shown")).alias("first"), F.min("code").alias("code"))
    return once.groupBy("title").agg(*[
        agg.alias(f"{what}_{source}")
        for source in ("infobox", "text")
        for what, agg in (
            ("codes", F.collect_set(F.when(F.col("source") == source, F.col("code")))),
            ("names", F.sort_array(F.collect_list(F.when(F.col("source") == source, F.col("first.shown"))))),
        )
    ])


_CODES = "array<struct<code:string,category:string>>"


def category_countries(cats: Column, lang: str) -> Column:
    """(code, category) for each nationality word in a category and each state after "from", where the category ends with it.

    All words are one automaton, so a category is read once however long the dictionary is.
    """
    words, states = dict(demonyms(lang)), frozenset(US_STATES)

    def found(lists: pa.Array) -> pa.Array:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for word, code in words.items():
            automaton.add_word(word, (word, code))
        automaton.make_automaton()
        out = []
        for categories in lists.to_pylist():
            here = []
            for category in categories or ():
                clean = category.replace("_", " ")
                here += [{"code": code, "category": clean} for _, code in sorted({hit for _, hit in automaton.iter(clean)})]
                at = clean.find("from ")
                while at >= 0:
                    if clean[at + 5:] in states:
                        here.append({"code": "US", "category": clean})
                    at = clean.find("from ", at + 1)
            out.append(here)
        return pa.array(out, pa.list_(pa.struct([("code", pa.string()), ("category", pa.string())])))

    return F.arrow_udf(found, _CODES)(cats)


def country(pages: DataFrame, places: DataFrame, lang: str) -> DataFrame:
    """(title, country, reasons): the one country all sources agree on.

    Categories must name it; links in the infobox and in the first paragraph may confirm it.
    """
    by_category = pages.select("title", category_countries(F.col("categories"), lang).alias("cats")).filter(F.size("cats") > 0)
    rows = by_category.join(_linked_places(pages, places, lang), "title", "left")

    def or_empty(c: str) -> Column:
        return F.coalesce(F.col(c), _strings())

    codes = F.array_distinct(F.concat(or_empty("codes_infobox"), or_empty("codes_text"), F.transform("cats", lambda x: x["code"])))
    belongs = quoted_list("category", F.sort_array(F.transform("cats", lambda x: x["category"])))
    reasons = F.array_compact(F.array(
        F.when(F.size(or_empty("names_infobox")) > 0, text("Infobox links to ", quoted_list("", or_empty("names_infobox")), ".")),
        F.when(F.size(or_empty("names_text")) > 0, text("The first paragraph links to ", quoted_list("", or_empty("names_text")), ".")),
        text("Belongs to ", belongs, "."),
    ))
    return rows.select("title", codes.alias("codes"), reasons.alias("reasons")).filter(F.size("codes") == 1).select(
        "title", F.col("codes")[0].alias("country"), "reasons")


# Gender --------------------------------------------------------------------------------------------

# Pronouns and category words per gender.
PRONOUNS = {"en": {"male": ("he", "his"), "female": ("she", "her")}, "fr": {"male": ("il",), "female": ("elle",)}}
CATEGORY_WORDS = {
    "male": (r"(?i)\bmale\b", r"(?i)^(Chanteur|Acteur|Animateur)\b"),
    "female": (r"(?i)\bfemale\b", r"(?i)^(Chanteuse|Actrice|Animatrice)\b"),
}


def pronoun_count(source: Column | str, words: Sequence[str]) -> Column:
    """Whole-word occurrences, case ignored; letters outside ASCII end a word."""
    pattern = r"(?i)(?<![A-Za-z0-9_])(?:" + "|".join(words) + r")(?![A-Za-z0-9_])"
    return F.regexp_count(F.col(source) if isinstance(source, str) else source, F.lit(pattern))


def pronoun_vote(source: Column | str, lang: str) -> tuple[Column, Column]:
    """(gender, uses): more than two pronouns of one gender and none of the other."""
    male, female = (pronoun_count(source, PRONOUNS[lang][g]) for g in ("male", "female"))
    gender = F.when((male > 2) & (female == 0), "male").when((female > 2) & (male == 0), "female")
    return gender, F.greatest(male, female)


def _category_genders(cats: Column) -> Column:
    def of(category: Column) -> Column:
        return F.array_compact(F.array(*[
            F.when(category.rlike(p), F.struct(F.lit(g).alias("gender"), category.alias("category"))) for g, ps in CATEGORY_WORDS.items() for p in ps]))

    return F.flatten(F.transform(cats, of))


def gender(pages: DataFrame, lang: str, given_names: DataFrame | None = None) -> DataFrame:
    """(title, gender, reasons): first name, categories and pronouns must agree.

    ``given_names`` is (name, gender) for the language. In French the first part of a compound
    first name counts when the whole is unknown.
    """
    first = F.nullif(F.regexp_extract(F.replace("title", F.lit("_"), F.lit(" ")), r"^(\S+)\s", 1), F.lit(""))
    by_text, uses = pronoun_vote("text", lang)
    df = pages.select("title", first.alias("_first"), _category_genders(F.col("categories")).alias("_cats"), by_text.alias("_text"), uses.alias("_uses"))
    if given_names is not None:
        known = given_names.groupBy("name").agg(F.min("gender").alias("g"))
        df = df.join(known.select(F.col("name").alias("_first"), F.col("g").alias("_whole")), "_first", "left")
        if lang == "fr":
            part = F.nullif(F.regexp_extract("_first", r"^([^-]+)-", 1), F.lit(""))
            df = df.withColumn("_part", part).join(known.select(F.col("name").alias("_part"), F.col("g").alias("_of_part")), "_part", "left")
            df = df.withColumn("_name", F.coalesce("_whole", "_of_part"))
        else:
            df = df.withColumn("_name", F.col("_whole"))
    else:
        df = df.withColumn("_name", F.lit(None).cast("string"))
    genders = F.array_distinct(F.concat(
        F.array_compact(F.array("_name", "_text")), F.transform("_cats", lambda x: x["gender"])))
    reasons = F.array_compact(F.array(
        F.when(F.col("_name").isNotNull(), text('First name "', F.col("_first"), '" is a ', F.col("_name"), " first name.")),
        F.when(F.size("_cats") > 0, text("Belongs to ", quoted_list("category", F.transform("_cats", lambda x: x["category"])), ".")),
        F.when(F.col("_text").isNotNull(), text("The first paragraph uses ", F.col("_text"), " pronouns ", F.col("_uses"), " times.")),
    ))
    return df.select("title", genders.alias("g"), reasons.alias("reasons")).filter(F.size("g") == 1).select("title", F.col("g")[0].alias("gender"), "reasons")


# Type -------------------------------------------------------------------------------------------------

# Infobox field and values that tell the type.
BACKGROUND_FIELD = {"en": "background", "fr": "charte"}
PERSON_BACKGROUNDS = ("solo_singer", "vocal", "instrumentiste")
GROUP_BACKGROUNDS = ("group_or_band", "groupe")


def artist_type(pages: DataFrame, lang: str) -> DataFrame:
    """(title, type, reasons) with type ``person`` or ``group``; contradicting pages are left out."""
    field = BACKGROUND_FIELD[lang]
    background = F.coalesce(F.try_element_at("infobox", F.lit(field)), F.lit(""))
    is_person, is_group = background.isin(*PERSON_BACKGROUNDS), background.isin(*GROUP_BACKGROUNDS)
    has_data = F.coalesce(F.try_element_at("persondata", F.lit("name")), F.lit("")) != ""
    if lang == "fr":
        groups = F.filter("categories", lambda c: c.startswith("Groupe"))
    else:
        groups = F.filter("categories", lambda c: c.endswith("groups") | c.startswith("Musical groups"))
    types = F.array_compact(F.array(F.when(is_person | has_data, "person"), F.when(is_group | (F.size(groups) > 0), "group")))
    box = text(f'Infobox has "{field} = ', background, '".')
    reasons = F.array_compact(F.array(
        F.when(is_person, box),
        F.when(has_data, F.lit('Contains the "Persondata" infobox.')),
        F.when(is_group, box),
        F.when(F.size(groups) > 0, text("Belongs to ", quoted_list("category", groups), ".")),
    ))
    return pages.select("title", types.alias("t"), F.array(F.array_join(reasons, " ")).alias("reasons")).filter(F.size("t") == 1).select(
        "title", F.col("t")[0].alias("type"), "reasons")


# Dates ---------------------------------------------------------------------------------------------------

# Where a date stands and how it is written.
DATE_FIELDS = {"begin": {"en": "birth_date", "fr": "naissance"}, "end": {"en": "death_date", "fr": "décès"}}
PERSONDATA_DATES = {"begin": "date of birth", "end": "date of death"}
DATE_TEMPLATES = {
    "begin": {
        "en": (r"(?i)^\{\{(?:Birth date and age|Birth date|Bda|dob)\|(\d+)\|(\w+)\|(\d+)", (1, 2, 3)),
        "fr": (r"(?i)^\{\{Date de naissance\|(\d+)\|([\wéû]+)\|(\d+)", (3, 2, 1)),
    },
    "end": {
        "en": (r"(?i)^\{\{(?:Death date and age|Dda)\|(\d+)\|(\w+)\|(\d+)", (1, 2, 3)),
        "fr": (r"(?i)^\{\{Date de décès\|(\d+)\|([\wéû]+)\|(\d+)", (3, 2, 1)),
    },
}
DATE_CATEGORIES = {
    ("person", "begin"): {"en": r"(?i)^(\d{4}) births", "fr": r"(?i)^Naissance en (\d{4})"},
    ("person", "end"): {"en": r"(?i)^(\d{4}) deaths", "fr": r"(?i)^Décès en (\d{4})"},
    ("group", "begin"): {"en": r"(?i)^Musical groups established in (\d{4})", "fr": r"(?i)^Groupe de musique formé en (\d{4})"},
    ("group", "end"): {"en": r"(?i)^Musical groups disestablished in (\d{4})"},
}
MONTHS = {
    "en": "january february march april may june july august september october november december".split(),
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split(),
}
DATE_FORMATS = ("MMMM d, yyyy", "d MMMM yyyy", "yyyy-MM-dd")

DATE = "struct<year:int,month:int,day:int,reason:string>"


def _date(year: Column, month: Column, day: Column, reason: Column) -> Column:
    return F.struct(year.cast("int").alias("year"), month.cast("int").alias("month"), day.cast("int").alias("day"), reason.alias("reason"))


def _nothing() -> Column:
    return F.lit(None).cast("int")


def date_from_persondata(which: str) -> Column:
    field = PERSONDATA_DATES[which]
    value = F.try_element_at("persondata", F.lit(field))
    parsed = F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in DATE_FORMATS])
    reason = text(f"Persondata has {field} \"", value, '".')
    bare = F.trim(value).try_cast("int")
    return F.when(parsed.isNotNull(), _date(F.year(parsed), F.month(parsed), F.dayofmonth(parsed), reason)).when(
        bare.isNotNull() & (bare != 0), _date(bare, _nothing(), _nothing(), reason))


def date_from_infobox(which: str, lang: str) -> Column:
    value = F.coalesce(F.try_element_at("infobox", F.lit(DATE_FIELDS[which][lang])), F.lit(""))
    pattern, (y, m, d) = DATE_TEMPLATES[which][lang]
    month = F.regexp_extract(value, pattern, m)
    by_name = F.nullif(F.array_position(F.array(*[F.lit(x) for x in MONTHS[lang]]), F.lower(month)).cast("int"), F.lit(0))
    month_number = F.when(month.rlike(r"^[0-9]+\z"), month.try_cast("int")).otherwise(by_name)
    year, day = (F.regexp_extract(value, pattern, g).try_cast("int") for g in (y, d))
    return F.when(value.rlike(pattern) & (year != 0), _date(year, month_number, day, text("Infobox has ", value, ".")))


def date_from_category(who: str, which: str, lang: str) -> Column:
    pattern = DATE_CATEGORIES[(who, which)].get(lang)
    if pattern is None:
        return F.lit(None).cast(DATE)
    hit = F.try_element_at(F.filter("categories", lambda c: c.rlike(pattern)), F.lit(1))
    year = F.regexp_extract(hit, pattern, 1).try_cast("int")
    return F.when(hit.isNotNull(), _date(year, _nothing(), _nothing(), text('Belongs to category "', hit, '"')))


def dates(pages: DataFrame, lang: str) -> DataFrame:
    """(title, person_begin, person_end, group_begin, group_end), each (year, month, day, reason) or NULL."""
    def person(which: str) -> Column:
        return F.coalesce(date_from_persondata(which), date_from_infobox(which, lang), date_from_category("person", which, lang))

    return pages.select(
        "title",
        *[person(w).alias(f"person_{w}") for w in ("begin", "end")],
        *[date_from_category("group", w, lang).alias(f"group_{w}") for w in ("begin", "end")],
    )


# Filling gaps -------------------------------------------------------------------------------------------


def performance_names(a: Catalog) -> DataFrame:
    """(id): artists that another artist performs as."""
    links = a.link.filter(F.col("link_type") == LINK_TYPE["performs_as"]).select(F.col("id").alias("link"))
    return a.l_artist_artist.join(links, "link", "left_semi").select(F.col("entity1").alias("id")).distinct()


def fill_artist_data(
    artists: DataFrame, country_facts: DataFrame, gender_facts: DataFrame, type_facts: DataFrame, date_facts: DataFrame,
    country_ids: DataFrame, gender_ids: DataFrame, performance: DataFrame | None = None,
) -> DataFrame:
    """Artists ``(id, gid, url, title, country, type, gender, begin_*, end_*)`` with their gaps filled.

    Returns the changed artists with ``updated`` (names of the changed fields) and ``note``. Only
    NULL fields are filled; gender and a person's dates need the (old or new) type to be person,
    and a performance name gets no dates. The dictionaries are ``(key, value)``.
    """
    facts = (
        artists.join(country_facts.select("title", F.col("country").alias("_c"), F.col("reasons").alias("_c_why")), "title", "left")
        .join(type_facts.select("title", F.col("type").alias("_t"), F.col("reasons").alias("_t_why")), "title", "left")
        .join(gender_facts.select("title", F.col("gender").alias("_g"), F.col("reasons").alias("_g_why")), "title", "left")
        .join(date_facts, "title", "left")
        .join(country_ids.select(F.col("key").alias("_c_key"), F.col("value").alias("_c_id")), F.lower("_c") == F.col("_c_key"), "left")
        .join(gender_ids.select(F.col("key").alias("_g_key"), F.col("value").alias("_g_id")), F.col("_g") == F.col("_g_key"), "left")
    )
    if performance is not None:
        facts = facts.join(performance.select("id", F.lit(True).alias("_perf")), "id", "left")
    else:
        facts = facts.withColumn("_perf", F.lit(None).cast("boolean"))
    type_id = F.when(F.col("_t") == "person", PERSON).when(F.col("_t") == "group", GROUP)
    df = facts.withColumns({
        "_set_country": F.col("country").isNull() & F.col("_c_id").isNotNull(),
        "_set_type": F.col("type").isNull() & type_id.isNotNull(),
        "country": F.coalesce("country", F.col("_c_id").cast("int")),
        "type": F.coalesce("type", type_id),
    })
    df = df.withColumn("_set_gender", F.col("gender").isNull() & (F.coalesce(F.col("type"), F.lit(0)) == PERSON) & F.col("_g_id").isNotNull())
    df = df.withColumn("gender", F.when(F.col("_set_gender"), F.col("_g_id").cast("int")).otherwise(F.col("gender")))
    is_person = (F.col("type") == PERSON) & ~F.coalesce("_perf", F.lit(False))
    for which in ("begin", "end"):
        date = F.when(is_person, F.col(f"person_{which}")).when(F.col("type") == GROUP, F.col(f"group_{which}"))
        year = f"{which}_date_year"
        df = df.withColumn(f"_{which}", F.when(F.col(year).isNull(), date))
        new = F.col(f"_{which}")
        df = df.withColumn(f"_set_{which}", new["year"].isNotNull())
        for part in ("year", "month", "day"):
            c = f"{which}_date_{part}"
            df = df.withColumn(c, F.when(F.col(f"_set_{which}"), new[part]).otherwise(F.col(c)))
    parts = [
        ("country", "COUNTRY", F.array_join("_c_why", " ")), ("type", "TYPE", F.array_join("_t_why", " ")),
        ("gender", "GENDER", F.array_join("_g_why", " ")), ("begin", "BEGIN DATE", F.col("_begin.reason")), ("end", "END DATE", F.col("_end.reason")),
    ]
    field = {"begin": "begin_date", "end": "end_date"}
    updated = F.array_compact(F.array(*[F.when(F.col(f"_set_{p}"), F.lit(field.get(p, p))) for p, _, _ in parts]))
    notes = [F.when(F.col(f"_set_{p}"), text(f"\n\n{head}:\n", why)).otherwise("") for p, head, why in parts]
    keep = ["id", "gid", "url", "country", "type", "gender", *[f"{w}_date_{p}" for w in ("begin", "end") for p in ("year", "month", "day")]]
    return df.select(*keep, updated.alias("updated"), text("From ", F.col("url"), *notes).alias("note")).filter(F.size("updated") > 0)
