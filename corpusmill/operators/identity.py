"""Ids, issuers and regions: look-up, allocation, repair, and carrying changes through derived tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import host, id_segments, short_hash
from .tables import one_row


def issuer_short(issuer: Column, city_code: Column, channel_type: Column) -> Column:
    """Short code of an issuer, else province and channel, else OTHER."""
    m = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    place = F.concat_ws("_", F.coalesce(F.try_element_at(m(rules.PROVINCE_SHORT), F.substring(city_code, 1, 2)), F.lit("OTHER")), F.coalesce(F.try_element_at(m(rules.CHANNEL_SHORT), F.coalesce(channel_type, F.lit(""))), F.lit("X")))
    return F.coalesce(F.try_element_at(m(rules.ISSUER_SHORT), F.coalesce(issuer, F.lit(""))), F.when(F.length(F.coalesce(city_code, F.lit(""))) >= 2, place), F.lit("OTHER"))


def compute_id(date: Column, issuer: Column, number: Column, title: Column, city_code: Column, channel_type: Column) -> Column:
    """P_<year>_<issuer>_<number or hash>."""
    d = F.coalesce(date, F.lit(""))
    year = F.split_part(F.when(d == "", F.lit("1900")).otherwise(d), F.lit("-"), F.lit(1))
    digits = F.regexp_extract(F.coalesce(number, F.lit("")), r"(\d+)\s*号", 1)
    tail = F.when(F.coalesce(number, F.lit("")) == "", short_hash(F.concat_ws("|", d, F.coalesce(title, F.lit(""))), 8)).when(digits != "", digits).otherwise(short_hash(number, 8))
    return F.concat_ws("_", F.lit("P"), year, issuer_short(issuer, city_code, channel_type), tail)


def infer_region(issuer: Column, city: Column, code: Column) -> Column:
    """STRUCT<level, code, name> from the code's shape."""
    of = lambda *x: F.struct(*[(c if isinstance(c, Column) else F.lit(c)).alias(n) for n, c in zip(("level", "code", "name"), x)])
    has = F.coalesce(city, F.lit("")) != ""
    c = F.coalesce(code, F.lit(""))
    return F.when(has & (c == "000000"), of("国家", "000000", "全国")).when(has & c.endswith("0000"), of("省", c, city)).when(has, of("市", c, city)).when(issuer.isin(*rules.ISSUER_SHORT), of("国家", "000000", "全国")).otherwise(of("", "", ""))


def alias_index(docs: DataFrame, rule: str = "first") -> DataFrame:
    """(key, doc_id): ids and aliases as look-up keys (C3). rule: first = the first document by pos that claims a key; id = ids win over aliases, then pos."""
    k = docs.select("doc_id", "pos", F.posexplode(F.concat(F.array("doc_id"), F.coalesce("aliases", F.array().cast(docs.schema["aliases"].dataType)))).alias("rank", "key")).where(F.coalesce(F.col("key").cast("string"), F.lit("")) != "")
    order = [F.col("pos")] if rule == "first" else [F.when(F.col("rank") == 0, 0).otherwise(1), F.col("pos")]
    w = Window.partitionBy("key").orderBy(*order, "doc_id")
    return k.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("key", "doc_id")


def lookup_or_queue(rows: DataFrame, index: DataFrame, key: str, reason: str = "manifest_pid_not_found") -> tuple[DataFrame, DataFrame]:
    """(found with located_id, queue with reason) (C4)."""
    i = index.select(F.col("key").alias("_key"), F.col("doc_id").alias("located_id"))
    j = rows.join(i, F.col(key) == F.col("_key"), "left").drop("_key")
    return j.where(F.col("located_id").isNotNull()), j.where(F.col("located_id").isNull()).drop("located_id").withColumn("reason", F.lit(reason))


def host_lookup(docs: DataFrame, registry: DataFrame, url: str = "url") -> DataFrame:
    """docs with the registry's columns by exact host (C23); the registry's last row of a domain by pos counts (A7); without pos, one by hash."""
    r = registry.withColumn("_pos", F.col("pos") if "pos" in registry.columns else F.xxhash64(*registry.columns))
    w = Window.partitionBy("domain").orderBy(F.desc("_pos"))
    r = r.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_pos").drop("pos")
    return docs.withColumn("_host", host(F.col(url))).join(r, F.col("_host") == F.lower(F.col("domain")), "left").drop("_host")


def allocate_ids(requests: DataFrame, taken: DataFrame, slots: str = "abcdefghij") -> DataFrame:
    """requests (row_id, base, pos) with new_id: the first free of base, base_a … base_j, several requests of one base in order of pos; null when all are taken.

    taken: (id). Free names are ranked per base, requests too, and joined by rank, so what is handed out in this run is taken for the next.
    """
    names = F.transform(F.array(F.lit(""), *[F.lit(f"_{c}") for c in slots]), lambda s: F.concat(F.col("base"), s))
    options = requests.select("base").distinct().select("base", F.posexplode(names).alias("slot", "new_id")).join(taken.select(F.col("id").alias("new_id")).distinct(), "new_id", "left_anti")
    w = Window.partitionBy("base")
    free = options.withColumn("_rank", F.row_number().over(w.orderBy("slot"))).select(F.col("base").alias("_base"), "_rank", "new_id")
    asked = requests.withColumn("_r", F.row_number().over(w.orderBy("pos", "row_id")))
    return asked.join(free, (F.col("base") == F.col("_base")) & (F.col("_r") == F.col("_rank")), "left").drop("_base", "_rank", "_r")


def numbered_names(rows: DataFrame, name: str = "name", *order: str) -> DataFrame:
    """rows with unique_name: name, name__1, name__2 …."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(*order)) - 1
    return rows.withColumn("_n", n).withColumn("unique_name", F.when(F.col("_n") == 0, F.col(name)).otherwise(F.concat(F.col(name), F.lit("__"), F.col("_n").cast("string")))).drop("_n")


def remap(rows: DataFrame, mapping: DataFrame, archived: DataFrame, cols: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with new ids, rows that touch an archived id) (C21). mapping: (old_id, new_id), archived: (id)."""
    cols = list(cols)
    gone = F.lit(False)
    d = rows
    for k, c in enumerate(cols):
        a = archived.select(F.col("id").alias(f"_a{k}")).distinct()
        m = one_row(mapping.select(F.col("old_id").alias(f"_o{k}"), F.col("new_id").alias(f"_m{k}")), [f"_o{k}"])
        d = d.join(a, F.col(c) == F.col(f"_a{k}"), "left").join(m, F.col(c) == F.col(f"_o{k}"), "left")
        gone = gone | F.col(f"_a{k}").isNotNull()
    d = d.withColumn("_gone", gone)
    helper = [f"_{p}{k}" for k in range(len(cols)) for p in "aom"] + ["_gone"]
    moved = d.where(~F.col("_gone"))
    for k, c in enumerate(cols):
        moved = moved.withColumn(c, F.coalesce(F.col(f"_m{k}"), F.col(c)))
    return moved.drop(*helper), d.where("_gone").drop(*helper)


def orphans(derived: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """Derived rows without a raw row."""
    return derived.join(raw.select(key).distinct(), key, "left_anti")


def malformed(pid: Column) -> Column:
    return ~F.coalesce(pid, F.lit("")).rlike(r"^P_\d{4}_[A-Z]+_")


def resolve_identity(docs: DataFrame, registry: DataFrame, taken: DataFrame, this_year: int) -> DataFrame:
    """Repairs of region, issuer, date and id against the registry of domains, only where they are broken.

    docs: doc_id, title, url, date, issuer array, region struct<level,code,name>, title_issuer (from the title, or null), body_date (issuance date in the body, or ''), date_is_other
    (the date stands in the body as an effective date or deadline), pos. Each repaired field is a STRUCT<value, method, confidence, was>, null where nothing changes; conflicts is an array of STRUCT<field, reason>.
    """
    reg = registry.select("domain", F.col("issuer_short").alias("r_short"), F.col("issuer_canonical").alias("r_issuer"), F.col("region").alias("r_region"), *(["pos"] if "pos" in registry.columns else []))
    d = host_lookup(docs, reg)
    known = F.col("r_short").isNotNull()
    fix = lambda v, method, conf, was: F.struct(v.alias("value"), F.lit(method).alias("method"), F.lit(conf).alias("confidence"), was.cast("string").alias("was"))
    name = F.coalesce("region.name", F.lit(""))
    region_bad = F.col("region").isNull() | name.isin("", "未知", "None") | ((F.col("r_region.level") != "国家") & (F.col("region.level") == "国家"))
    who = F.array_join(F.coalesce("issuer", F.array().cast("array<string>")), " ")
    garbage = (who == "") | who.contains("gov.cn") | who.contains("政府门户") | who.startswith("http")
    place = F.regexp_replace(F.coalesce("r_region.name", F.lit("")), "省|市", "")
    backed = (F.col("r_region.level") == "国家") | ((place != "") & F.expr("contains(title_issuer, regexp_replace(coalesce(r_region.name, ''), '省|市', ''))"))
    titled = F.coalesce("title_issuer", F.lit("")) != ""
    date = F.coalesce("date", F.lit(""))
    date_ok = date.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.substring(date, 1, 4).try_cast("int").between(1990, this_year)
    body = F.coalesce("body_date", F.lit(""))
    date_fix = F.when(known & ~date_ok & (body != ""), fix(body, "body_chinese_date", 0.92, date)).when(known & date_ok & (body != "") & (body != date) & F.coalesce("date_is_other", F.lit(False)), fix(body, "body_chinese_date", 0.9, date))
    d = d.withColumn("region_fix", F.when(known & F.coalesce(region_bad, F.lit(True)), F.struct(F.col("r_region").alias("value"), F.lit("domain_lookup").alias("method"), F.lit(0.99).alias("confidence"), F.to_json("region").alias("was"))))
    d = d.withColumn("issuer_fix", F.when(known & garbage & titled & F.coalesce(backed, F.lit(False)), fix(F.array("title_issuer"), "title_extract", 0.95, who)))
    d = d.withColumn("date_fix", date_fix)
    final = F.coalesce("date_fix.value", date)
    year = F.when(final.rlike(r"^\d{4}") & F.substring(final, 1, 4).try_cast("int").between(1990, this_year), F.substring(final, 1, 4))
    seg = id_segments(F.col("doc_id"))
    prefix = F.when(F.size(F.split("doc_id", "_")) >= 4, F.get(F.split("doc_id", "_"), F.lit(2))).otherwise(F.lit(""))
    wants = known & (prefix.isin("GO", "SC") | malformed(F.col("doc_id")) | F.col("date_fix").isNotNull())
    d = d.withColumn("_wants", wants).withColumn("_year", year).withColumn("_base", F.concat_ws("_", F.lit("P"), F.col("_year"), F.col("r_short"), F.coalesce(F.nullif(seg["tail"], F.lit("")), F.element_at(F.split("doc_id", "_"), -1))))
    asked = d.where(F.col("_wants") & F.col("_year").isNotNull() & (F.col("_base") != F.col("doc_id"))).select(F.col("doc_id").alias("row_id"), F.col("_base").alias("base"), "pos")
    got = allocate_ids(asked, taken).select(F.col("row_id").alias("_id"), "new_id", F.lit(True).alias("_asked"))
    d = d.join(got, F.col("doc_id") == F.col("_id"), "left")
    d = d.withColumn("id_fix", F.when(F.col("new_id").isNotNull(), fix(F.col("new_id"), "id_recompute_from_metadata", 0.99, F.col("doc_id"))))
    conflict = lambda f, r: F.struct(F.lit(f).alias("field"), F.lit(r).alias("reason"))
    conflicts = F.array_compact(F.array(
        F.when(~known, conflict("_all", "domain_not_in_registry")), F.when(known & garbage & titled & ~F.coalesce(backed, F.lit(False)), conflict("issuer", "title_issuer_contradicts_domain_region")),
        F.when(known & ~date_ok & (body == ""), conflict("date", "date_broken_and_no_issuance_date")), F.when(F.col("_wants") & F.col("_year").isNull(), conflict("id", "no_usable_year")), F.when(F.col("_asked") & F.col("new_id").isNull(), conflict("id", "id_slots_exhausted")),
    ))
    return d.withColumn("conflicts", conflicts).drop("_wants", "_year", "_base", "_id", "_asked", "new_id", "r_short", "r_issuer", "r_region", "domain")


FIXES = ("region", "issuer", "date", "id")


def without_contradicted(resolved: DataFrame, ledger: DataFrame) -> DataFrame:
    """resolved, but rows whose new id names another issuer than the ledger lose all their repairs and get a conflict _all instead."""
    checked = cross_check(resolved.where("id_fix IS NOT NULL").select("doc_id", F.col("id_fix.value").alias("new_id")), ledger).where("NOT agrees").select(F.col("doc_id").alias("_x"))
    j = resolved.join(checked, F.col("doc_id") == F.col("_x"), "left")
    out = j.withColumn("conflicts", F.when(F.col("_x").isNotNull(), F.array(F.struct(F.lit("_all").alias("field"), F.lit("contradicts_ledger").alias("reason")))).otherwise(F.col("conflicts")))
    for f in FIXES:
        out = out.withColumn(f"{f}_fix", F.when(F.col("_x").isNull(), F.col(f"{f}_fix")))
    return out.drop("_x")


def apply_repairs(docs: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(docs with their repairs, mapping (old_id, new_id)). Rows without a repair stay as they are; an unrepaired field too."""
    fixes = resolved.select(F.col("doc_id").alias("_r"), *[f"{f}_fix" for f in FIXES])
    j = docs.join(fixes, F.col("doc_id") == F.col("_r"), "left").drop("_r")
    mapping = j.where("id_fix IS NOT NULL").select(F.col("doc_id").alias("old_id"), F.col("id_fix.value").alias("new_id"))
    out = j.withColumn("doc_id", F.coalesce("id_fix.value", "doc_id"))
    for f in FIXES[:-1]:
        out = out.withColumn(f, F.coalesce(f"{f}_fix.value", f))
    return out.drop(*[f"{f}_fix" for f in FIXES]), mapping


def cross_check(changes: DataFrame, ledger: DataFrame) -> DataFrame:
    """changes (doc_id, new_id) with agrees against the ledger (doc_id, issuer_short): the issuer segment of the new id equals the ledger's; rows the ledger lacks agree."""
    l = ledger.select(F.col("doc_id").alias("_l"), F.col("issuer_short").alias("_s"))
    return changes.join(l, F.col("doc_id") == F.col("_l"), "left").withColumn("comparable", F.col("_s").isNotNull()).withColumn("agrees", F.col("_s").isNull() | (id_segments(F.col("new_id"))["issuer"] == F.col("_s"))).drop("_l", "_s")


def id_issuer_findings(docs: DataFrame, canonical: dict[str, str], keywords: dict[str, Iterable[str]]) -> DataFrame:
    """Documents whose id names another issuer than their issuer list (G31): the canonical name of the id's code must occur, else one of its keywords."""
    code = id_segments(F.col("doc_id"))["issuer"]
    who = F.array_join(F.coalesce("issuer", F.array().cast("array<string>")), " ")
    m = F.create_map(*[F.lit(x) for kv in canonical.items() for x in kv])
    ok = F.lit(False)
    for c, words in keywords.items():
        for w in words:
            ok = ok | ((F.col("_code") == c) & who.contains(w))
    d = docs.withColumn("_code", code).withColumn("expected", F.try_element_at(m, F.col("_code")))
    hit = F.coalesce(F.expr("contains(array_join(coalesce(issuer, array()), ' '), expected)"), F.lit(False)) | F.coalesce(ok, F.lit(False))
    return d.where(F.col("expected").isNotNull() & (who != "") & ~hit).drop("_code")


def remint(docs: DataFrame, fixes: DataFrame, on: str) -> DataFrame:
    """Ids replaced by fixes (doc_id, new_id, method): the old id becomes an alias, and an audit map says when, how and from what."""
    f = fixes.select(F.col("doc_id").alias("_f"), "new_id", "method")
    d = docs.join(f, F.col("doc_id") == F.col("_f"), "left")
    aliases = F.when(F.col("new_id").isNotNull(), F.array_union(F.coalesce("aliases", F.array().cast("array<string>")), F.array("doc_id"))).otherwise(F.col("aliases"))
    audit = F.when(F.col("new_id").isNotNull(), F.create_map(F.lit("id_fixed_at"), F.lit(on), F.lit("id_fixed_method"), F.col("method"), F.lit("id_fixed_from"), F.col("doc_id"))).otherwise(F.create_map().cast("map<string,string>"))
    return d.withColumn("aliases", aliases).withColumn("audit", audit).withColumn("doc_id", F.coalesce("new_id", "doc_id")).drop("_f", "new_id", "method")


def province_of(code: Column) -> Column:
    return F.concat(F.substring(code, 1, 2), F.lit("0000"))


def seed_registry(channels: DataFrame, by_name: dict[str, str], by_label: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(seeded, needs_manual) of channels (domain, name): issuer by a word of the name, else by a label of the host."""
    name = F.coalesce(*[F.when(F.col("name").contains(w), F.lit(v)) for w, v in by_name.items()])
    m = F.create_map(*[F.lit(x) for kv in by_label.items() for x in kv])
    label = F.get(F.filter(F.transform(F.split("domain", r"\."), lambda s: F.try_element_at(m, s)), lambda x: x.isNotNull()), F.lit(0))
    d = channels.withColumn("issuer_short", F.coalesce(name, label)).withColumn("seeded_by", F.when(name.isNotNull(), "name").when(label.isNotNull(), "host_label"))
    return d.where(F.col("issuer_short").isNotNull()), d.where(F.col("issuer_short").isNull()).drop("issuer_short", "seeded_by")


def region_rollup(rows: DataFrame, regions: DataFrame, code: str = "region_code") -> DataFrame:
    """(province_code, province_name, n): rows counted by the province of their region code (C26). regions: (code, name)."""
    r = regions.select(F.col("code").alias("province_code"), F.col("name").alias("province_name"))
    n = rows.groupBy(province_of(F.col(code)).alias("province_code")).agg(F.count("*").alias("n"))
    return n.join(r, "province_code", "left")
