"""Declared schemas (DDL text); nothing is inferred from data."""

MESSAGE = "data BINARY, attributes MAP<STRING,STRING>, publish_time TIMESTAMP"

RADIO_SAMPLE = (
    "ts TIMESTAMP, localdatetime STRING, center_freq DOUBLE, sample_rate DOUBLE, data DOUBLE"
)

# Nested warehouse table for radio samples.
RADIO_TABLE = (
    "data DOUBLE NOT NULL, attribute STRUCT<localdatetime: STRING NOT NULL,"
    " center_freq: DOUBLE, sample_rate: DOUBLE> NOT NULL"
)

CHANNEL_SIDE = "ARRAY<STRUCT<value: DOUBLE, start: STRING, end: STRING>>"
CHANNEL_JSON = f"MAP<STRING, STRUCT<congestion: {CHANNEL_SIDE}, average: {CHANNEL_SIDE}>>"

VITALS_CSV = "id LONG, vital INT"
PATIENTS_CSV = "id LONG, name STRING, birth_year INT, gender STRING"

WEATHER_CSV = (
    "localdatetime STRING, icon STRING, precip STRING, summary STRING,"
    " temp DOUBLE, time STRING, uv DOUBLE, wind DOUBLE"
)
LABELS_CSV = "datetime STRING, vehicles INT, people INT"

WEATHER_PAYLOAD = (
    "currently STRUCT<time: LONG, summary: STRING, icon: STRING, precipProbability: DOUBLE,"
    " temperature: DOUBLE, uvIndex: DOUBLE, windSpeed: DOUBLE>"
)

_ENTITIES = (
    "STRUCT<hashtags: ARRAY<STRUCT<text: STRING, indices: ARRAY<INT>>>,"
    " user_mentions: ARRAY<STRUCT<id_str: STRING, screen_name: STRING, name: STRING,"
    " indices: ARRAY<INT>>>>"
)
TWEET = (
    "id_str STRING, created_at STRING, timestamp_ms STRING, lang STRING, text STRING,"
    f" truncated BOOLEAN, extended_tweet STRUCT<full_text: STRING, entities: {_ENTITIES}>,"
    f" entities {_ENTITIES}, source STRING,"
    " coordinates STRUCT<type: STRING, coordinates: ARRAY<DOUBLE>>,"
    " user STRUCT<id_str: STRING, location: STRING, geo_enabled: BOOLEAN,"
    " statuses_count: LONG, followers_count: LONG, friends_count: LONG>,"
    " place STRUCT<id: STRING, place_type: STRING, full_name: STRING, country_code: STRING,"
    " country: STRING, bounding_box: STRUCT<type: STRING,"
    " coordinates: ARRAY<ARRAY<ARRAY<DOUBLE>>>>>"
)

# One annotated sentence per row; arrays keep document order.
SENTENCE = (
    "url STRING, page_order LONG, sent_id LONG,"
    " tokens ARRAY<STRUCT<id: STRING, word: STRING, ner: STRING>>,"
    " entities ARRAY<STRUCT<id: STRING, type: STRING, end: STRING>>,"
    " relations ARRAY<STRUCT<type: STRING, args: ARRAY<STRUCT<id: STRING, type: STRING>>,"
    " probs ARRAY<STRUCT<label: STRING, value: DOUBLE>>>>"
)

# The same sentence as the annotator's XML spells it (rowTag "sentence").
SENTENCE_XML = (
    "_id LONG,"
    " tokens STRUCT<token: ARRAY<STRUCT<_id: STRING, word: STRING, NER: STRING>>>,"
    " MachineReading STRUCT<"
    "entities: STRUCT<entity: ARRAY<STRUCT<_VALUE: STRING, _id: STRING,"
    " span: STRUCT<_start: STRING, _end: STRING>>>>,"
    " relations: STRUCT<relation: ARRAY<STRUCT<_VALUE: STRING, _id: STRING,"
    " arguments: STRUCT<entity: ARRAY<STRUCT<_VALUE: STRING, _id: STRING>>>,"
    " probabilities: STRUCT<probability: ARRAY<STRUCT<label: STRING, value: STRING>>>>>>>"
)

IQ_FRAME = "ts TIMESTAMP, center_freq DOUBLE, re ARRAY<DOUBLE>, im ARRAY<DOUBLE>"
