"""Column names and types of the feeds and of the tables derived from them."""

from pyspark.sql import types as T

# Column names of the public event and mention feeds, in file order.
EVENT_FEED = [
    "GLOBALEVENTID", "Day", "MonthYear", "Year", "FractionDate", "Actor1Code", "Actor1Name", "Actor1CountryCode",
    "Actor1KnownGroupCode", "Actor1EthnicCode", "Actor1Religion1Code", "Actor1Religion2Code", "Actor1Type1Code",
    "Actor1Type2Code", "Actor1Type3Code", "Actor2Code", "Actor2Name", "Actor2CountryCode", "Actor2KnownGroupCode",
    "Actor2EthnicCode", "Actor2Religion1Code", "Actor2Religion2Code", "Actor2Type1Code", "Actor2Type2Code",
    "Actor2Type3Code", "IsRootEvent", "EventCode", "EventBaseCode", "EventRootCode", "QuadClass", "GoldsteinScale",
    "NumMentions", "NumSources", "NumArticles", "AvgTone", "Actor1Geo_Type", "Actor1Geo_FullName",
    "Actor1Geo_CountryCode", "Actor1Geo_ADM1Code", "Actor1Geo_ADM2Code", "Actor1Geo_Lat", "Actor1Geo_Long",
    "Actor1Geo_FeatureID", "Actor2Geo_Type", "Actor2Geo_FullName", "Actor2Geo_CountryCode", "Actor2Geo_ADM1Code",
    "Actor2Geo_ADM2Code", "Actor2Geo_Lat", "Actor2Geo_Long", "Actor2Geo_FeatureID", "ActionGeo_Type",
    "ActionGeo_FullName", "ActionGeo_CountryCode", "ActionGeo_ADM1Code", "ActionGeo_ADM2Code", "ActionGeo_Lat",
    "ActionGeo_Long", "ActionGeo_FeatureID", "DATEADDED", "SOURCEURL",
]
MENTION_FEED = [
    "GLOBALEVENTID", "EventTimeDate", "MentionTimeDate", "MentionType", "MentionSourceName", "MentionIdentifier",
    "SentenceID", "Actor1CharOffset", "Actor2CharOffset", "ActionCharOffset", "InRawText", "Confidence",
    "MentionDocLen", "MentionDocTone", "MentionDocTranslationInfo", "Extras",
]
EVENT_COLUMNS = [
    "GLOBALEVENTID", "Day", "Actor1Name", "Actor1CountryCode", "Actor2Name", "Actor2CountryCode", "EventCode",
    "EventRootCode", "GoldsteinScale", "NumArticles", "AvgTone", "Actor1Geo_CountryCode", "Actor2Geo_CountryCode",
    "ActionGeo_FullName", "ActionGeo_CountryCode", "ActionGeo_Lat", "ActionGeo_Long", "DATEADDED", "SOURCEURL",
]
MENTION_COLUMNS = [
    "GLOBALEVENTID", "MentionTimeDate", "MentionSourceName", "MentionIdentifier", "SentenceID", "InRawText",
    "Confidence", "MentionDocLen", "MentionDocTone",
]
ENRICHMENT_COLUMNS = [
    "article_title", "article_keywords", "enriched",
]
ARTICLE_COLUMNS = [
    "doc_id", "global_event_id", "url", "headline", "country", "country_code", "latitude", "longitude", "cameo_code",
    "cameo_label", "actor", "risk_category", "goldstein", "event_date", "date_added", "confidence", "in_raw_text",
    "mention_doc_tone", "mention_time",
]
# The article columns of the serving store, in order.
STORE_ARTICLE_COLUMNS = [
    "doc_id", "document_identifier", "mention_identifier", "global_event_id", "in_raw_text", "confidence",
    "mention_doc_tone", "country", "risk_category", "goldstein", "cameo_code", "cameo_label", "actor", "latitude",
    "longitude", "event_date", "date_added", "age_days", "mention_time",
]


def text_schema(names) -> T.StructType:
    """All strings: feeds are typed only when gold is built."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


EVENT_FEED_SCHEMA, MENTION_FEED_SCHEMA = text_schema(EVENT_FEED), text_schema(MENTION_FEED)
PROFILE_SCHEMA = "user_id string, display_name string, territories array<string>, keywords map<string,array<string>>, briefing_days int, older_news_days int, status string"
TAG_SCHEMA = "user_id string, tags map<string,string>"
TERRITORY_SCHEMA = "name string, cameo array<string>, fips array<string>"
LABEL_SCHEMA = "lookup_code string, lookup_label string"
assert len(EVENT_FEED) == 61 and len(MENTION_FEED) == 16 and len(EVENT_COLUMNS) == 19 and len(MENTION_COLUMNS) == 9
