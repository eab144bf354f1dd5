"""Fixed lookup lists and readers for the dictionaries that are files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from catlink import schemas
from catlink.functions.text import extract

# Country names of catalog B that differ from catalog A, with their ISO codes.
COUNTRY_NAMES = """
AG Antigua & Barbuda
AN Netherlands Antilles
BA Bosnia & Herzegovina
BN Brunei
BO Bolivia
BS Bahamas, The
CD Congo, Democratic Republic of the
CG Congo, Republic of the
CS Serbia and Montenegro
GB UK
IR Iran
KP North Korea
KR South Korea
MD Moldova
MK Macedonia
MM Burma
MO Macau
PF Clipperton Island
PN Pitcairn Islands
RE Reunion
RU Russia
SU USSR
SY Syria
TF French Southern & Antarctic Lands
TF Europa Island
TL East Timor
TT Trinidad & Tobago
TZ Tanzania
UM Wake Island
UM Kingman Reef
US US
VA Vatican City
VA Holy See (Vatican City)
VC Saint Vincent and the Grenadines
VE Venezuela
VN Vietnam
XC Czechoslovakia
XG German Democratic Republic (GDR)
YU Yugoslavia
"""

# Beginnings of a comment or profile that name a country, by ISO code ("|" separates).
COUNTRY_SEARCH = """
AG antigua & barbuda%
AN netherlands antilles%
AR argentinian%
AT austrian%
AU australian%
BA bosnia & herzegovina%
BE belgian%
BN brunei%
BO bolivia%
BR brazilian%
BS bahamas, the%
CA canadian%
CD congo, democratic republic of the%
CG congo, republic of the%|republic of the congo%
CH swiss%
CN chinese%
CS serbia and montenegro%
CU cuban%
CZ czech%
DE german%
DK danish%
DZ algerian%
EE estonian%
ES spanish%
FI finnish%
FR french%
GB uk %|english%|british%|scottish%|welsh%
GR greek%
HK hong kong%
HR croatian%
HU hungarian%
ID indonesian%
IE irish%
IL israeli%
IN indian%
IR iranian%|iran%
IS icelandic%
IT italian%
JM jamaican%
JP japanese%
KP north korea%
KR south korean%|south korea%
LV latvian%
MD moldova%
MK macedonia%
MM burma%
MO macau%
MX mexican%
MZ mozambican%
NL dutch%
NO norwegian%
NZ new zealand%
PF clipperton island%
PH filipino%
PK pakistani%
PL polish%
PN pitcairn islands%
PR puerto rican%
PT portugal%
RE reunion%
RO romanian%
RU russian%|russia%
SE swedish%
SG singaporean%
SI slovenian%
SK slovak%
SN senegalese%
SU ussr%
SY syria%
TL east timor%
TR turkish%
TZ tanzania%
UA ukrainian%
UM wake island%|kingman reef%
US us %|american%|usa %|los angeles %|san francisco %
VA vatican city%|holy see (vatican city)%
VC saint vincent and the grenadines%
VE venezuela%
VN vietnam%
XC czechoslovakia%
XG german democratic republic%
YU yugoslavia%
ZA south african%
"""

# Nationality words inside category names.
DEMONYMS = {
    "en": """
American US
English GB
British GB
Scottish GB
Welch GB
Belgian BE
Dutch NL
French FR
Polish PL
Swiss CH
Italian IT
Pakistani PK
Spanish ES
German DE
Greek GR
Australian AU
Canadian CA
Indonesian ID
Swedish SE
Brazilian BR
Irish IE
Korean KR
Japanese JP
Chinese CN
Russian RU
Hungarian HU
Slovak SK
Slovenian SI
Czech CZ
Ukrainian UA
Turkish TR
Romanian RO
Portugal PT
Norwegian NO
Mexican MX
Latvian LV
Estonian EE
Finnish FI
Austrian AT
Israeli IL
South African ZA
Puerto Rican PR
Senegalese SN
Croatian HR
Danish DK
Icelandic IS
Jamaican JM
New Zealand NZ
Algerian DZ
Cuban CU
Hong Kong HK
Singaporean SG
Filipino PH
Republic of the Congo CG
Mozambican MZ
""",
    "fr": """
américain US
anglais GB
britannique GB
écossais GB
gallois GB
belge BE
hollandais NL
français FR
polonais PL
suisse CH
italien IT
pakistanais PK
espagnol ES
allemand DE
grec GR
australien AU
canadien CA
québécois CA
indonésien ID
suédois SE
brésilien BR
irlandais IE
coréen KR
japonais JP
chinois CN
russe RU
hongrois HU
slovaque SK
tchèque CZ
ukrainien UA
turc TR
roumain RO
portugais PT
norvégien NO
marocain MA
mexicain MX
letton LV
estonien EE
finlandais FI
autrichien AT
israélien IL
sud-africain ZA
Puerto Rican PR
sénégalais SN
croate HR
danois DK
islandais IS
jamaïcain JM
nouveau-zélandais NZ
algérien DZ
cubain CU
Hong Kong HK
tunisien TN
monégasque MC
breton FR
""",
}

# Page titles of the states of the USA.
US_STATES = """
Alabama
Alaska
Arizona
Arkansas
California
Colorado
Connecticut
Delaware
Florida
Georgia
Hawaii
Idaho
Illinois
Indiana
Iowa
Kansas
Kentucky
Louisiana
Maine
Maryland
Massachusetts
Michigan
Minnesota
Mississippi
Missouri
Montana
Nebraska
Nevada
New Hampshire
New Jersey
New Mexico
New York
North Carolina
North Dakota
Ohio
Oklahoma
Oregon
Pennsylvania
Rhode Island
South Carolina
South Dakota
Tennessee
Texas
Utah
Vermont
Virginia
Washington
Washington D.C.
Washington, D.C.
West Virginia
Wisconsin
Wyoming
""".strip().split("\n")


def code_first(text: str) -> list[tuple[str, str]]:
    """Lines ``CODE name`` -> (code, name)."""
    return [tuple(line.split(" ", 1)) for line in text.strip().split("\n")]


def code_last(text: str) -> list[tuple[str, str]]:
    """Lines ``name CODE`` -> (name, code)."""
    return [tuple(line.rsplit(" ", 1)) for line in text.strip().split("\n")]


def country_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(code_first(COUNTRY_NAMES), "iso_code string, name string")


def country_search(spark: SparkSession) -> DataFrame:
    rows = [(code, patterns.split("|")) for code, patterns in code_first(COUNTRY_SEARCH)]
    return spark.createDataFrame(rows, "iso_code string, search array<string>")


def demonyms(lang: str) -> list[tuple[str, str]]:
    return code_last(DEMONYMS[lang])


def read_roles(spark: SparkSession, path: str) -> DataFrame:
    """Role dictionary file: tab-separated, ``\\N`` is NULL, no quoting."""
    return spark.read.schema(schemas.ROLES).option("sep", "\t").option("nullValue", "\\N").option("quote", "").csv(path)


def script_ranges(lines: DataFrame) -> DataFrame:
    """Lines ``A..B ; Script`` or ``A ; Script`` (hexadecimal) -> (script, lo, hi).

    Blank lines and lines that begin with ``#`` are skipped.
    """
    text = F.trim("value")
    lo = extract(text, r"^([0-9A-Fa-f]+)")
    hi = extract(text, r"^[0-9A-Fa-f]+\.\.([0-9A-Fa-f]+)")
    parsed = lines.filter((text != "") & ~text.startswith("#")).select(
        extract(text, r"^[^;]*;\s*(\S+)").alias("script"),
        F.conv(lo, 16, 10).cast("int").alias("lo"),
        F.conv(F.coalesce(hi, lo), 16, 10).cast("int").alias("hi"),
    )
    return parsed.filter("script IS NOT NULL AND lo IS NOT NULL")


def read_script_ranges(spark: SparkSession, path: str) -> DataFrame:
    return script_ranges(spark.read.text(path))


def given_names(lines: DataFrame) -> DataFrame:
    """First token of each line in lower case, each name once."""
    first = F.lower(extract(F.col("value"), r"^\s*(\S+)"))
    return lines.select(first.alias("name")).filter("name IS NOT NULL").distinct()


def read_given_names(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return given_names(spark.read.text(list(paths)))


def titles(lines: DataFrame, lang: str | None = None) -> DataFrame:
    """Title lines -> (id, name, lang); the language is the first two letters of the file name."""
    value = F.regexp_replace("value", r"[\r\n]+\z", "")
    language = F.lit(lang) if lang else F.left(F.element_at(F.split("file", "/"), -1), F.lit(2))
    return lines.select(value.alias("id"), F.replace(value, F.lit("_"), F.lit(" ")).alias("name"), language.alias("lang"))


def read_titles(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return titles(spark.read.text(list(paths)).select("value", F.col("_metadata.file_name").alias("file")))


def named_codes(lines: DataFrame) -> DataFrame:
    """Lines ``name<TAB>value`` -> (name, code), both trimmed: page titles of countries, or given names with their gender.

    Blank lines and lines that begin with ``#`` are skipped.
    """
    parts = F.split(F.regexp_replace("value", r"[\r\n]+\z", ""), "\t")
    rows = lines.filter(~F.col("value").startswith("#")).select(F.trim(parts[0]).alias("name"), F.trim(F.try_element_at(parts, F.lit(2))).alias("code"))
    return rows.filter("name <> '' AND code <> ''").distinct()


def read_country_titles(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(name, code) of the country pages of one encyclopedia."""
    return named_codes(spark.read.text(list(paths)))


def read_name_genders(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(name, gender) of the given names of one language."""
    return named_codes(spark.read.text(list(paths))).withColumnRenamed("code", "gender")
