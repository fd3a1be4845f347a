"""Explicit schemas (DDL) of everything that is read; unknown keys go to a map, nothing is inferred."""

DOCUMENTS = "doc_id string, aliases array<string>, title string, official_number string, issuer array<string>, date string, region struct<level:string,code:string,name:string>, url string, fm map<string,string>, body string, path string"
EDGES = "candidate_id string, `from` string, `to` string, rel string, confidence string, evidence string, source string, judge_reason string"
CHANNELS = "city string, province string, level string, city_code string, channel_type string, root_domain string, list_url string, source string, status string, last_probed_at string, probe_result string, notes string"
CHANNEL_STATUS = ("待验证", "验证", "失效")
FEED = "items array<struct<id:string,url:string,title:string,content_html:string,content_text:string,date_published:string,date_modified:string,author:struct<name:string>,author_name:string,authors:array<struct<name:string>>>>"
REGISTRY = "domain string, issuer_short string, issuer_canonical string, region struct<level:string,code:string,name:string>, pos bigint"
THEMES = "theme_id string, label string, aliases array<string>, pos bigint"
VERDICTS = "candidate_id string, decision string, confidence double, reason string"
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
