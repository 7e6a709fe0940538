"""Row normalizers: JSON rows of a source as typed records with an error code, quality flags and the lineage of each field.

A record is built by expressions over a VARIANT of the row, so a whole table is normalized in the JVM; only the NFC step is an Arrow
UDF. A row has the code of the first rule that it breaks and keeps its payload, so nothing is lost.

Defined results: a text that is no JSON object is ROW_NOT_OBJECT; repeated keys make it invalid JSON; null, empty and absent values are
missing; numbers count as text where a text is asked for, booleans, fractions and nested values don't; digits of any script are digits;
other columns are passed on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import text_hash
from ..functions.temporal import date_kind, stated_day, stated_instant
from ..functions.text import ascii_digits, nfc, source_text


def pointer(key: str) -> str:
    return "/" + key.replace("~", "~0").replace("/", "~1")


class Row:
    """Fields of one source row; collects what they are made of and the rules that they may break, in order."""

    def __init__(self, row: Column, partition: Column | None = None):
        self.row, self.partition = row, partition
        self.fields: dict[str, Column] = {}
        self.lineage: dict[str, list[str]] = {}
        self.rules: list[tuple[Column, str]] = []
        self.flags: list[tuple[Column, str]] = []
        self.identity: Column = F.lit(None).cast("string")

    def raw(self, key: str) -> Column:
        return F.try_variant_get(self.row, f"$['{key}']", "string")

    def kind(self, key: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(self.row, f"$['{key}']", "variant"))

    def broken(self, condition: Column, code: str) -> None:
        self.rules.append((F.coalesce(condition, F.lit(False)), code))

    def _keep(self, target: str, value: Column, *keys: str) -> Column:
        self.fields[target] = value
        self.lineage[target] = [pointer(k) for k in keys]
        return value

    def text(self, target: str, key: str, required: bool = False) -> Column:
        given = F.coalesce(self.raw(key), F.lit("")) != ""
        self.broken(given & ~self.kind(key).isin("STRING", "BIGINT"), "INVALID_STRING")
        value = source_text(F.regexp_replace(self.raw(key), "\r\n?", "\n"))
        if required:
            self.broken(value.isNull(), "MISSING_REQUIRED_FIELD")
        return self._keep(target, value, key)

    def number(self, target: str, key: str, required: bool = False) -> Column:
        given = F.coalesce(self.raw(key), F.lit("")) != ""
        digits = ascii_digits(self.raw(key))
        fits = self.kind(key).isin("STRING", "BIGINT") & digits.rlike("^[0-9]+$")
        self.broken(~F.coalesce(fits, F.lit(False)) & (F.lit(True) if required else given), "INVALID_NONNEGATIVE_INTEGER")
        return self._keep(target, F.when(fits, digits.try_cast("long")), key)

    def day(self, target: str, key: str) -> Column:
        value = source_text(self.raw(key))
        digits = ascii_digits(value)
        day = F.when(digits.rlike("^[0-9]{8}$"), F.to_date(F.try_to_timestamp(digits, F.lit("yyyyMMdd"))))
        self.broken(value.isNotNull() & day.isNull(), "INVALID_DATE")
        return self._keep(target, day, key)

    def derived(self, target: str, value: Column, *keys: str) -> Column:
        return self._keep(target, value, *keys)


def competency(r: Row) -> None:
    code = r.text("code", "ncsClCd", required=True)
    r.broken(~code.rlike("^[0-9]{10}_[0-9]{2}v[0-9]+$"), "INVALID_CODE")
    level = r.number("level", "compeUnitLevel", required=True)
    r.flags.append((level == 0, "UNSPECIFIED_LEVEL"))
    r.derived("level", F.nullif(level, F.lit(0)), "compeUnitLevel")
    r.text("name", "compeUnitName", required=True)
    r.text("definition", "compeUnitDef")
    r.derived("occupation_code", F.substring(code, 1, 8), "ncsClCd")
    r.text("occupation_name", "ncsSubdCdnm", required=True)
    names = ("ncsLclasCdnm", "ncsMclasCdnm", "ncsSclasCdnm")
    r.derived("classification_names", F.array(*[F.coalesce(r.raw(n), F.lit("")) for n in names]), *names)
    r.identity = code


def qualification(r: Row) -> None:
    code = r.text("competency_code", "ncsClCd", required=True)
    r.broken((r.partition != F.concat(F.lit("ncs-"), code)) | ~code.rlike("^[0-9]{10}_[0-9]{2}v[0-9]+$"), "PARTITION_IDENTITY_MISMATCH")
    own = r.text("qualification_code", "jmCd", required=True)
    r.text("qualification_name", "jmNm", required=True)
    version = r.text("standard_version", "organStdVerCd", required=True)
    r.text("unit_type", "abltUnitTypCd", required=True)
    r.number("minimum_training_hours", "minEduTrngTm")
    r.number("total_training_hours", "eduTrngStdTmSum")
    r.text("examining_organization", "examInstiNm")
    r.identity = F.concat_ws(":", code, own, version)


#: Dates of a session: fixed field names, and which two bound a range.
SESSION_DATES = ("docRegStartDt", "docRegEndDt", "docExamStartDt", "docExamEndDt", "docPassDt", "pracRegStartDt", "pracRegEndDt", "pracExamStartDt", "pracExamEndDt", "pracPassDt")


def exam_session(r: Row) -> None:
    year, item = (F.regexp_extract(r.partition, "^year-([0-9]{4})-item-([A-Z0-9]{4})$", k) for k in (1, 2))
    r.broken((year == "") | ~r.raw("implYy").eqNullSafe(year) | (F.coalesce(F.nullif(r.raw("jmCd"), F.lit("")), item) != item), "PARTITION_IDENTITY_MISMATCH")
    dates = {k: r.day(k, k) for k in SESSION_DATES}
    for start, end in ((k, k.replace("Start", "End")) for k in SESSION_DATES if "Start" in k):
        r.broken(dates[start] > dates[end], "REVERSED_DATE_RANGE")
    r.derived("qualification_code", item)
    r.lineage["qualification_code"] = ["request:partition_id"]
    own_year, turn = r.number("year", "implYy", required=True), r.number("round", "implSeq", required=True)
    category = r.text("category_code", "qualgbCd", required=True)
    r.text("name", "description", required=True)
    r.identity = F.concat_ws(":", item, own_year, category, turn)


def organization(r: Row) -> None:
    r.identity = r.text("code", "instCd", required=True)
    r.text("name", "instNm", required=True)
    for target, key in (("government_code", "pbadmsStdInstCd"), ("organization_type", "instTypeNm"), ("supervising_organization_code", "sprvsnInstCd"), ("website", "siteUrl"), ("address", "roadNmAddr")):
        r.text(target, key)
    r.day("established_date", "fndnYmd")


def posting(r: Row) -> None:
    own = r.text("posting_id", "recrutPblntSn", required=True)
    kind = F.when(r.partition.startswith("detail-"), "detail").otherwise("list")
    r.broken((kind == "detail") & (r.partition != F.concat(F.lit("detail-"), own)), "PARTITION_IDENTITY_MISMATCH")
    r.derived("representation", kind)
    r.lineage["representation"] = ["request:partition_id"]
    ongoing = F.coalesce(r.raw("ongoingYn"), F.lit(""))
    r.broken(~ongoing.isin("Y", "N", ""), "INVALID_ONGOING_STATUS")
    r.derived("ongoing", F.when(ongoing != "", ongoing == "Y"), "ongoingYn")
    first, last = r.day("date_posted", "pbancBgngYmd"), r.day("closing_date", "pbancEndYmd")
    r.broken(first.isNull() | last.isNull() | (last < first), "INVALID_POSTING_DATE_RANGE")
    for target, key in (("title", "recrutPbancTtl"), ("organization_code", "pblntInstCd"), ("organization_name", "instNm")):
        r.text(target, key, required=True)
    for target, key in (
        ("source_url", "srcUrl"), ("recruitment_type", "recrutSeNm"), ("education", "acbgCondNmLst"), ("employment_type", "hireTypeNmLst"), ("regions", "workRgnNmLst"), ("category_codes", "ncsCdLst"), ("category_names", "ncsCdNmLst"),
        ("eligibility_text", "aplyQlfcCn"), ("disqualification_text", "disqlfcRsn"), ("preference_text", "prefCn"), ("selection_text", "scrnprcdrMthdExpln"),
    ):
        r.text(target, key)
    r.number("headcount", "recrutNope")
    r.identity = F.concat_ws(":", own, kind)


def career_path(r: Row) -> None:
    keys = ("대분류코드", "중분류코드", "소분류코드", "직무코드", "직무역량코드")
    two = []
    for k in keys:
        digits = ascii_digits(r.raw(k))
        r.broken(~F.coalesce(digits.rlike("^[0-9]+$"), F.lit(False)), "INVALID_NONNEGATIVE_INTEGER")
        short = F.regexp_replace(digits, "^0+(?=.)", "")
        r.broken(F.length(short) > 2, "INVALID_CODE")
        two.append(F.lpad(short, 2, "0"))
    occupation = r.derived("occupation_code", F.concat(*two[:4]), *keys[:4])
    r.derived("competency_code", F.concat(occupation, two[4]), *keys)
    r.text("occupation_name", "직무명", required=True)
    r.text("competency_name", "직무역량명", required=True)
    r.number("competency_level", "직무역량수준(능력단위수준 이면서 세분류의 자식)", required=True)
    r.number("rank_level", "수준(직급수준)", required=True)
    r.text("rank_name", "직급명", required=True)
    r.identity = text_hash(F.to_json(F.struct(*[c.alias(n) for n, c in sorted(r.fields.items())]), {"ignoreNullFields": "false"}))


KINDS = {"competency": competency, "qualification": qualification, "exam_session": exam_session, "organization": organization, "posting": posting, "career_path": career_path}

#: Words that sources write in place of a name or a date: fixed values.
NO_EMPLOYER = ("비공개", "기업명 비공개", "회사명 비공개", "미공개", "-", "(주)", "㈜")
EMPLOYER_CATEGORY = r"^(중소기업|중견기업|대기업|벤처기업|대기업 계열사.?자회사|외국계 기업|외국계기업|공기업|공공기관|비영리단체|협회|재단)(\s*\([^)]*\))?$"
CLOSED = ("CLOSED", "마감", "채용마감", "접수마감")
ROLLING, UNTIL_FILLED = ("상시채용", "상시", "수시채용"), ("채용시까지", "채용 시까지", "채용시 마감", "채용 시 마감")
NO_ROLE = ("홈페이지 지원", "홈페이지지원", "온라인 지원", "온라인지원", "이메일 지원", "이메일지원", "방문 지원", "방문지원")
LISTING_TEXTS = {
    "salary": "salary_raw", "experience_level": "experience_raw", "education_level": "education", "employment_type": "employment_type", "work_location": "regions", "work_hours": "work_hours", "company_size": "company_size",
    "company_type": "company_type", "industry": "industry", "job_functions": "job_functions", "application_method": "application_method", "benefits": "benefits_text",
}


def listing(row: Column, url: str) -> dict[str, Column]:
    """A supplied listing's fields, all ``errors`` (array of code and field) and all quality ``flags``; ``url``: pattern of its page with the id as group 1."""
    get = lambda k: F.try_variant_get(row, f"$['{k}']", "string")
    kind = lambda k: F.coalesce(F.schema_of_variant(F.try_variant_get(row, f"$['{k}']", "variant")), F.lit("VOID"))
    given = lambda k: kind(k) != "VOID"
    said = lambda k: F.when(kind(k) == "STRING", F.nullif(F.trim(get(k)), F.lit("")))
    error = lambda c, code, field: F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(field).alias("field")))
    native = F.when(kind("product_page_url") == "STRING", F.nullif(F.regexp_extract(get("product_page_url"), url, 1), F.lit("")))
    title, company = said("job_title"), said("company_name")
    employer = F.when(company.isNull() | company.isin(*NO_EMPLOYER), "UNKNOWN").when(company.rlike(EMPLOYER_CATEGORY), "CATEGORY_ONLY").otherwise("NAME_UNVERIFIED")
    status = F.when((get("is_closed") == "true") & (kind("is_closed") == "BOOLEAN") | (get("closed") == "true") & (kind("closed") == "BOOLEAN") | F.upper(F.coalesce(get("source_status"), get("status"), F.lit(""))).isin(*CLOSED), "CLOSED").otherwise("UNKNOWN")
    status = F.coalesce(status, F.lit("UNKNOWN"))
    dates = {}
    for k in ("application_start_date", "application_end_date"):
        dates[k] = F.when(~given(k), F.lit(None).cast("string")).when(kind(k) != "STRING", "INVALID").otherwise(date_kind(get(k)))
    start, end = "application_start_date", "application_end_date"
    rolling, until = get(end).isin(*ROLLING), get(end).isin(*UNTIL_FILLED)
    worded = F.coalesce((kind(end) == "STRING") & (rolling | until), F.lit(False))
    deadline = F.when(~given(end) & (status == "CLOSED"), "UNKNOWN").when(~given(end), "ROLLING").when(worded & rolling, "ROLLING").when(worded, "UNTIL_FILLED").when(dates[end] == "INVALID", "UNKNOWN").when(dates[end] == "DAY", "FIXED_DATE").otherwise("FIXED_INSTANT")
    basis = F.when(~given(end) & (status == "CLOSED"), "SOURCE_STATUS").when(~given(end), "USER_POLICY").when(~worded & (dates[end] == "INVALID"), "INVALID_SOURCE_FIELD").otherwise("SOURCE_FIELD")
    a, b = stated_day(get(start)), F.when(~worded, stated_day(get(end)))
    at, until_at = stated_instant(get(start)), F.when(~worded, stated_instant(get(end)))
    role = F.when(~F.coalesce(said("job_position").isin(*NO_ROLE), F.lit(False)), said("job_position"))
    # an empty main text is missing even where a second one is given
    content = F.when(kind("description_text") == "STRING", said("description_text")).otherwise(said("job_description_text"))
    count_ok = (kind("recruitment_count") == "BIGINT") & get("recruitment_count").rlike("^[0-9]+$") & get("recruitment_count").try_cast("int").isNotNull()
    tags = F.try_variant_get(row, "$.company_benefits_tags", "array<string>")
    plain_tags = kind("company_benefits_tags").isin("ARRAY<STRING>", "ARRAY<VOID>")
    errors = [
        error(native.isNull(), "INVALID_POSTING_REFERENCE", "product_page_url"),
        error(title.isNull(), "MISSING_OR_INVALID_TITLE", "job_title"),
        error(given("company_name") & (kind("company_name") != "STRING"), "INVALID_TEXT_TYPE", "company_name"),
        *[error(given(k) & (kind(k) != "STRING"), "INVALID_DATE_TYPE", k) for k in (start,)],
        error((kind(start) == "STRING") & (dates[start] == "INVALID"), "INVALID_DATE", start),
        error(given(end) & (kind(end) != "STRING"), "INVALID_DATE_TYPE", end),
        error(~worded & (kind(end) == "STRING") & (dates[end] == "INVALID"), "INVALID_DATE", end),
        error((b < a) | (until_at < at), "END_BEFORE_START", end),
        *[error(given(k) & (kind(k) != "STRING"), "INVALID_TEXT_TYPE", k) for k in ("job_position", "description_text", "job_description_text")],
        error(given("recruitment_count") & ~F.coalesce(count_ok, F.lit(False)), "INVALID_RECRUITMENT_COUNT", "recruitment_count"),
        *[error(given(k) & (kind(k) != "STRING"), "INVALID_TEXT_TYPE", k) for k in LISTING_TEXTS],
        error(F.try_variant_get(row, "$.company_benefits_tags", "variant").isNotNull() & ~plain_tags, "INVALID_BENEFITS_TAGS", "company_benefits_tags"),
    ]
    flags = [
        F.when(employer == "CATEGORY_ONLY", "EMPLOYER_CATEGORY_ONLY"), F.when(employer == "UNKNOWN", "EMPLOYER_UNKNOWN"), F.when(~given(start), "APPLICATION_START_MISSING"), F.when(basis == "USER_POLICY", "DEADLINE_ASSUMED_ROLLING"),
        F.when(F.coalesce(said("job_position").isin(*NO_ROLE), F.lit(False)), "ROLE_IS_APPLICATION_METHOD"), F.when(content.isNull(), "DESCRIPTION_MISSING"),
    ]
    return {
        "posting_id": native, "title": title, "company_name_raw": company, "employer_identity_kind": employer, "organization_name": F.when(employer == "NAME_UNVERIFIED", company), "source_status": status,
        "application_start_date": a, "application_start_at": at, "deadline_kind": deadline, "deadline_basis": basis, "deadline_date": b, "deadline_at": until_at, "role": role, "description_text": content,
        "content_status": F.when(content.isNull(), "MISSING").otherwise("TEXT_AVAILABLE"), "headcount": F.when(count_ok, get("recruitment_count").try_cast("int")), "benefits_tags": F.when(plain_tags, tags),
        **{target: F.when(kind(k) == "STRING", get(k)) for k, target in LISTING_TEXTS.items()},
        "errors": F.array_compact(F.array(*errors)), "flags": F.array_compact(F.array(*flags)),
    }


def parsed(body: Column, normal: bool = True) -> Column:
    """The row as VARIANT, in NFC; null where it is no JSON object with unique keys."""
    row = F.try_parse_json(body)
    whole = F.when(F.schema_of_variant(row).startswith("OBJECT"), row)
    return F.try_parse_json(nfc(F.to_json(whole))) if normal else whole


def normalize(df: DataFrame, body: str, kind: str, partition: str | None = None, normal: bool = True) -> DataFrame:
    """``df`` with ``source_record_id``, ``normalized`` (struct), ``error_code``, ``flags`` and ``lineage`` of JSON rows of a kind of :data:`KINDS`."""
    d = df.withColumn("_row", parsed(F.col(body), normal))
    r = Row(F.col("_row"), F.col(partition) if partition else F.lit(""))
    KINDS[kind](r)
    code = reduce(lambda out, x: out.when(*x), r.rules, F.when(F.col("_row").isNull(), "ROW_NOT_OBJECT"))
    flags = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(F.coalesce(c, F.lit(False)), n) for c, n in r.flags]))
    lineage = F.create_map(*[x for k, v in r.lineage.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    d = d.withColumns({"error_code": code, "source_record_id": r.identity, "normalized": F.struct(*[c.alias(n) for n, c in r.fields.items()]), "flags": flags, "lineage": lineage})
    good = F.col("error_code").isNull()
    return d.withColumns({c: F.when(good, F.col(c)) for c in ("source_record_id", "normalized", "flags", "lineage")}).drop("_row")


def normalize_listings(df: DataFrame, body: str, url: str, normal: bool = True) -> DataFrame:
    """``df`` with a listing's fields, ``errors`` and ``flags``; a text that is no JSON object has the error ROW_NOT_OBJECT."""
    d = df.withColumn("_row", parsed(F.col(body), normal))
    out = listing(F.col("_row"), url)
    no_row = F.array(F.struct(F.lit("ROW_NOT_OBJECT").alias("code"), F.lit("").alias("field")))
    out |= {"errors": F.when(F.col("_row").isNull(), no_row).otherwise(out["errors"]), "flags": F.when(F.col("_row").isNotNull(), out["flags"]).otherwise(F.array().cast("array<string>"))}
    return d.select(*df.columns, *[c.alias(n) for n, c in out.items()])
