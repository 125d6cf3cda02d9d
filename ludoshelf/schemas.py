"""Input contracts and the declared shape of the assembled record."""

from __future__ import annotations

LANDING = (
    "request_kind string, app_id bigint, locale string, steam_language string, store_country string, "
    "review_type string, page_no int, cursor string, http_status int, url string, "
    "fetched_at timestamp, body string"
)

REQUESTS = (
    "url string, languages array<string>, store_country string, "
    "positive_review_count int, negative_review_count int, review_pages int"
)

CANDIDATES = (
    "app_id bigint, variant_ord int, result_ord int, game_id bigint, game_name string, "
    "game_web_link string, main_story string, main_extra string, completionist string, "
    "all_styles string, similarity double, json_content string, error string"
)

DIAGNOSTIC = (
    "app_id bigint, stage int, ord int, source string, code string, message string, "
    "severity string, details map<string,string>"
)

TEXT = "struct<text:string,html:string>"
REQUIREMENTS = f"struct<minimum:{TEXT},recommended:{TEXT}>"
LOCALIZED = (
    "struct<locale:string,steam_language:string,store_country:string,name:string,"
    f"short_description:{TEXT},full_description:{TEXT}>"
)
IMAGE = "struct<thumbnail_url:string,full_url:string,id:bigint>"
VIDEO = (
    "struct<id:bigint,name:string,thumbnail_url:string,dash_av1_url:string,dash_h264_url:string,"
    "hls_h264_url:string,highlight:boolean>"
)
LANGUAGE = (
    "struct<name:string,steam_language:string,web_code:string,interface:boolean,"
    "subtitles:boolean,full_audio:boolean>"
)
CATEGORY = "struct<id:bigint,name:string,source:string>"
TAG = "struct<name:string,source:string,rank:int,votes:bigint>"
AGE_RATING = (
    "struct<authority:string,rating:string,required_age:bigint,descriptors:array<string>,"
    "banned:boolean,use_age_gate:boolean>"
)
RATING = (
    "struct<locale:string,review_language:string,store_country:string,score:bigint,"
    "score_description:string,total_positive:bigint,total_negative:bigint,total_reviews:bigint,"
    "positive_percent:double>"
)
AUTHOR = (
    "struct<steam_id:string,games_owned:bigint,reviews_written:bigint,playtime_forever_minutes:bigint,"
    "playtime_last_two_weeks_minutes:bigint,playtime_at_review_minutes:bigint,last_played:timestamp>"
)
REVIEW = (
    "struct<recommendation_id:string,text:string,positive:boolean,source_url:string,language:string,"
    "created_at:timestamp,updated_at:timestamp,votes_up:bigint,votes_funny:bigint,"
    "weighted_vote_score:double,comment_count:bigint,steam_purchase:boolean,received_for_free:boolean,"
    f"written_during_early_access:boolean,developer_response:string,author:{AUTHOR}>"
)
REVIEWS = (
    f"struct<positive:array<{REVIEW}>,negative:array<{REVIEW}>,pages_requested:int,"
    "positive_requested:int,negative_requested:int>"
)
ACHIEVEMENT = (
    "struct<api_name:string,name:string,description:string,global_percent:double,hidden:boolean,icon_url:string>"
)
HOURS = (
    "struct<id:bigint,name:string,url:string,main_story_hours:double,main_extra_hours:double,"
    "completionist_hours:double,all_styles_hours:double,raw:string>"
)
SCORE = (
    "struct<url:string,critic_score:bigint,user_score:double,user_score_raw:string,platform:string>"
)
PRICE = (
    "struct<currency:string,initial:bigint,final:bigint,discount_percent:bigint,"
    "initial_formatted:string,final_formatted:string>"
)
DIAGNOSTIC_ITEM = (
    "struct<source:string,code:string,message:string,severity:string,details:map<string,string>>"
)

# Field order of the assembled record.
GAME = {
    "platform": "string",
    "app_id": "bigint",
    "store_url": "string",
    "store_country": "string",
    "is_free": "boolean",
    "price": PRICE,
    "type": "string",
    "localizations": f"map<string,{LOCALIZED}>",
    "developers": "array<string>",
    "publishers": "array<string>",
    "release_date": "date",
    "release_date_raw": "string",
    "coming_soon": "boolean",
    "screenshots": f"array<{IMAGE}>",
    "videos": f"array<{VIDEO}>",
    "header_image": "string",
    "website": "string",
    "requirements": f"struct<windows:{REQUIREMENTS},mac:{REQUIREMENTS},linux:{REQUIREMENTS}>",
    "supported_languages": f"array<{LANGUAGE}>",
    "platforms": "map<string,boolean>",
    "categories": f"array<{CATEGORY}>",
    "genres": "array<string>",
    "tags": f"array<{TAG}>",
    "age_ratings": f"array<{AGE_RATING}>",
    "achievements": f"array<{ACHIEVEMENT}>",
    "achievements_url": "string",
    "steam_rating": RATING,
    "ratings_by_locale": f"map<string,{RATING}>",
    "reviews": REVIEWS,
    "metacritic": SCORE,
    "how_long_to_beat": HOURS,
    "diagnostics": f"array<{DIAGNOSTIC_ITEM}>",
}
