"""Schemas of the tables, and checks against them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


# Schemas are DDL strings, which need no session until they are used.
COUNTRY = "country_id int, name string, parliament_name string, seats int"
PARTY = "party_id string, acronym string, name string, mandates int, source_political_group_count int, source_political_groups string, interjection_mentions int, interjection_aliases string, wiki_url string, country_id int"
POLITICIAN = "mp_id string, first_name string, last_name string, birth_date date, birth_place string, education_level string, school string, academic_title string, profession string, languages string, seniority decimal(5,2), status string, country_id int"
MANDATE = "mp_id string, term string, party_id string, club string, list string, constituency string, committees string, mandate_start date, mandate_end date, election_date date, votes string, source_url string, country_id int"
MANDATE_PARTY = "mandate_id bigint, party_id string"
PRESIDENCY = "pr_id string, legislature int, president string, party string, start_date date, end_date date, mp_id string"
SPEECH = "speech_id bigint, speech_text string, speech_interjection string, speech_date date, speaker_id string, country_id int, term int"
SPEAKER = "struct<attributes:map<string,string>,Nom:string,role:string,gender:string>"
PARAGRAPH = f"struct<Ident:string,Para:string,Para_clean:string,section:string,sous_section_1:string,sous_section_2:string,Orateur:array<{SPEAKER}>>"
DOCUMENT = f"source_files array<string>, dateSeance string, numSeance string, Para array<{PARAGRAPH}>"
SUMMARY_ENTRY = "structure_level string, major_topic_order int, major_topic_number int, major_topic string, subtopic string, source_text string, warning string"

#: Primary keys, and foreign keys as (column, table, column).
KEYS = {"country": ["country_id"], "party": ["party_id"], "politician": ["mp_id"], "mandate": ["mp_id", "term"], "speech": ["speech_id"]}
FOREIGN_KEYS = {"mandate": [("mp_id", "politician", "mp_id")], "party": [("country_id", "country", "country_id")], "politician": [("country_id", "country", "country_id")]}


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame itself, if it has all these columns; else a KeyError that lists what it lacks."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {', '.join(missing)}")
    return df


def project(df: DataFrame, schema: str) -> DataFrame:
    """The schema's columns in its order and types; absent ones are null, others are dropped."""
    from pyspark.sql import functions as F

    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)])
