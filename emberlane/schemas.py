"""Schemas of the pipeline's tables, as DDL.

Fixed values: the names and types of outside tables, and the columns of merged
items in their order.
"""

TAG = "struct<id:bigint,initial:string,match:string,type:string>"
REF = "struct<GeoAssetID:bigint,GeoAssetName:string,confidence:double>"
COUNTRY = "struct<country:string,p:double>"
DERIVED = f"geo_tags array<{TAG}>, owner_tags array<{TAG}>, ref_match array<{REF}>, country_match array<{COUNTRY}>, events_tags array<string>"

POST_RAW = (
    "id bigint, id_str string, created_at string, full_text string, entities struct<hashtags:array<struct<text:string>>>, user_id bigint, user_id_str string, "
    "retweet_count bigint, favorite_count bigint, reply_count bigint, quote_count bigint, favorited boolean, retweeted boolean"
)
HEADLINE_RAW = "storyId string, firstCreated string, text string, snippet string, sourceName string, cluster_id string"
ASSETS_CSV = "GeoAssetID bigint, GeoAssetName string, City string, Latitude double, Longitude double, FromDate timestamp_ntz, ToDate timestamp_ntz"
OWNERS_CSV = "GeoAssetID bigint, CompanyName string"
PLACE_OF_PEOPLE_CSV = "NORP string, GPE string"
SCRAPED = f"globalObjects struct<tweets:map<string,struct<{', '.join(f'{n}:{t}' for n, t in (x.split(' ', 1) for x in POST_RAW.split(', ')))}>>>"
MERGED = (
    "id", "created_at", "text", "snippet", "source_id", "retweet_count", "favorite_count", "reply_count", "quote_count", "favorited", "retweeted", "entities",
    "geo_tags", "owner_tags", "ref_match", "events_tags", "country_match", "cluster_id",
)
