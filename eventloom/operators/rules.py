"""Decision lists: the accept/reject classifier and its gates, as one projection over any number of candidates."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import times

#: Fixed vocabularies of the Japanese rules.
DEFAULT_TERMS: dict[str, list[str]] = {
    "participation": ["参加方法", "参加条件", "join", "ジョイン", "リクイン", "reqin", "リクエストインバイト", "request invite", "招待", "フレンド申請", "フレリク", "グループインスタンス", "group instance", "group+", "group public", "フレンドインスタンス", "join制", "インスタンスへ", "インスタンスに", "インスタンスオープン"],
    "access": ["join", "ジョイン", "リクイン", "reqin", "リクエストインバイト", "request invite", "フレンド申請", "フレリク", "グループインスタンス", "group instance", "group+", "グループ＋", "group public", "フレンドインスタンス", "join制", "インスタンスへ", "インスタンスに", "インスタンスオープン"],
    "generic": ["イベント", "event"],
    "broadcast": ["配信予定", "コラボ配信", "ライブ配信", "youtube配信", "配信枠", "生配信"],
    "private": ["誕生日インスタンス", "birthday instance", "記念インスタンス", "インスタンスを開催"],
    "specific": ["イベント告知", "営業告知", "通常営業", "開催決定", "ホストイベント", "ホスイベ", "交流イベント", "集会", "交流会", "オークション", "ライブイベント", "公演", "djイベント", "vjイベント", "歌ステージ", "ステージ", "ワールドツアー", "ワールド巡り", "謎解き", "大会", "勉強会", "講演会", "講演", "セミナー", "上映会", "映画祭", "朗読会", "朗読劇", "朗読ミュージカル", "舞台公演", "演奏会", "音楽会", "撮影会", "展示会", "展覧会", "フェス", "festival", "祭り", "オフ会", "説明会", "体験会", "試写会", "フォトコン", "vrchatライブ", "performance live", "講習会"],
    "action": ["開催", "open", "オープン", "開場", "開始", "営業", "公演", "実施", "開演"],
    "attend": ["参加したい", "参加できます", "参加ください", "ご参加ください", "来場", "ご来場", "ご来店", "遊びに来て", "遊びにきて", "お越し", "見に来て", "聴きに来て", "お待ちしております", "お待ちしてます", "入場"],
    "recruit": ["キャスト募集", "スタッフ募集", "店員募集", "演者募集", "テスター募集", "参加者募集", "出展募集", "公募", "応募期限", "面接"],
    "deadline": ["締切", "〆切", "応募期限", "までに", "応募完了"],
    "world": ["ワールド紹介", "ワールドを更新", "常設", "いつでも", "販売開始", "公開しました"],
    "product": ["booth", "販売", "発売", "配布", "価格", "セール", "商品", "patreon", "記事", "キーチェーン", "衣装", "アバター"],
    "giveaway": ["プレゼント", "giveaway", "rpキャンペーン", "抽選", "当選", "フォロー＆rp", "フォロー&rp"],
    "generic_event": ["開催", "イベント", "キャンペーン", "募集", "応募"],
}


@dataclass(frozen=True)
class RuleSet:
    """What the rules look for. Passed explicitly; nothing global changes."""

    terms: dict[str, list[str]] = field(default_factory=lambda: DEFAULT_TERMS)
    marker: str | None = r"(?i)#?vrchat|#?vrc(?![a-z])"
    min_retweets: int = 3
    min_length: int = 12
    max_length: int = 1200
    malformed: tuple[str, ...] = ('\\",\\"', '"displayText"', '"rtCount"')
    past_hours: int = 12
    future_days: int = 180


def features(text: Column, rules: RuleSet) -> dict[str, Column]:
    out = {k: T.has_any(text, v) for k, v in rules.terms.items()}
    out["marked"] = F.lit(True) if rules.marker is None else F.coalesce(text, F.lit("")).rlike(rules.marker)
    return out


def structured(f: dict[str, Column]) -> tuple[Column, Column]:
    """(category, reason) by the first rule that holds; exactly one is null."""
    no = F.lit(False)
    g = lambda k: f.get(k, no)
    event = g("specific") | (g("generic") & g("action")) | (g("generic") & g("attend")) | (g("action") & g("access")) | (g("access") & g("attend"))
    recruitment = g("recruit") | (g("deadline") & g("access"))
    reason = (
        F.when(~g("marked"), "not_vrchat")
        .when(g("broadcast") & ~g("access") & ~g("attend"), "missing_event_marker")
        .when(g("giveaway") & ~event, "giveaway_only")
        .when(g("product") & ~event & ~recruitment, "product_only")
        .when(g("world") & ~g("specific") & ~(g("action") & g("access")), "missing_event_marker")
        .when(~recruitment & ~event, "missing_event_marker")
    )
    return F.when(reason.isNull(), F.when(recruitment, "recruitment_deadline").otherwise("event")), reason


#: Fixed vocabularies of the first, simpler rules.
SIMPLE_TERMS = {
    "event": ["イベント", "参加方法", "参加条件", "開催", "join", "ジョイン", "リクイン", "reqin", "リクエストインバイト", "request invite", "営業", "公演", "集会", "ライブ", "ツアー", "開場", "group instance", "グループインスタンス", "join先"],
    "recruitment": ["募集", "応募", "締切", "〆切", "テスター"],
}


def simple(text: Column, rules: RuleSet) -> tuple[Column, Column]:
    """(category, reason) by the first version of the rules."""
    event, recruitment = (T.has_any(text, SIMPLE_TERMS[k]) for k in ("event", "recruitment"))
    product, giveaway, tester = T.has_any(text, rules.terms["product"]), T.has_any(text, rules.terms["giveaway"]), T.has_any(text, ["テスター"])
    recruiting = recruitment & T.has_any(text, ["締切", "〆切", "応募", "テスター"])
    marked = F.lit(True) if rules.marker is None else F.coalesce(text, F.lit("")).rlike(rules.marker)
    reason = (
        F.when(~marked, "not_vrchat").when(giveaway & ~event, "giveaway_only").when(product & ~event & ~(recruitment & tester), "product_only")
        .when(~recruiting & ~event, "missing_event_marker")
    )
    return F.when(reason.isNull(), F.when(recruiting, "recruitment_deadline").otherwise("event")), reason


def _pre_gates(text: Column, f: dict[str, Column]) -> Column:
    no = F.lit(False)
    g = lambda k: f.get(k, no)
    return (
        F.when(times.month_conflict(text), "conflicting_date_context")
        .when(g("giveaway") & ~g("participation") & ~g("specific"), "giveaway_only")
        .when(g("product") & g("generic_event") & ~g("specific") & ~g("participation"), "product_only")
        .when(g("private") & ~g("participation"), "missing_participation_method")
    )


def accept_or_reject(candidates: DataFrame, now: Column, rules: RuleSet, known_ids: DataFrame | None = None) -> DataFrame:
    """The candidates with category, starts_at, reason (null if accepted) and accepted.

    candidates: status_id, text, retweet_count (string or number). known_ids: one column of ids seen elsewhere; they are
    joined by equality and only their presence counts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    f = features(text, rules)
    category, why = structured(f)
    df = candidates.withColumns({f"_f_{k}": v for k, v in f.items()})
    f = {k: F.col(f"_f_{k}") for k in f}
    category, why = structured(f)
    if known_ids is not None:
        ids = known_ids.select(F.col(known_ids.columns[0]).cast("string").alias("_id")).distinct().withColumn("_known", F.lit(True))
        df = df.join(ids, df["status_id"].cast("string") == ids["_id"], "left").drop("_id")
    else:
        df = df.withColumn("_known", F.lit(None).cast("boolean"))
    at, _ = times.relative_weekday(text, now)
    df = df.withColumn("_at", F.coalesce(times.event_datetime(text, now), at))
    count, plain = F.col("retweet_count").try_cast("long"), T.clean_text(text)
    reason = F.coalesce(
        _pre_gates(text, f),
        F.when(~F.col("status_id").cast("string").rlike(r"^[0-9]{10,25}$") | F.col("status_id").isNull(), "invalid_status_id"),
        F.when(F.col("_known"), "duplicate_x_source"),
        F.when(F.length(plain) < rules.min_length, "missing_text"),
        F.when((F.length(plain) > rules.max_length) | T.any_of(F.contains(text, F.lit(m)) for m in rules.malformed), "malformed_text"),
        why,
        F.when(F.col("retweet_count").isNull(), "retweet_count_missing"),
        F.when(count.isNull(), "retweet_count_invalid"),
        F.when(count < rules.min_retweets, "retweet_below_threshold"),
        F.when(F.col("_at").isNull(), "missing_datetime"),
        F.when(F.col("_at") < now - F.expr(f"interval {rules.past_hours} hours"), "past_event"),
        F.when(F.col("_at") > now + F.expr(f"interval {rules.future_days} days"), "too_far_future"),
    )
    out = df.withColumns({"category": category, "starts_at": F.col("_at"), "reason": reason})
    return out.withColumn("accepted", F.col("reason").isNull()).drop("_at", "_known", *(f"_f_{k}" for k in f))


def archive_status(starts_at: Column, now: Column) -> Column:
    return F.when(starts_at.isNull(), "unknown").when(starts_at < now, "past").otherwise("upcoming")


ALWAYS_REVIEW = ("conflicting_date_context", "missing_participation_method", "unknown", "retweet_count_missing", "retweet_count_invalid")
CONDITIONAL_REVIEW = ("missing_datetime", "missing_event_marker")


def needs_review(reason: Column, retweets: Column) -> Column:
    return F.coalesce(reason.isin(*ALWAYS_REVIEW) | (reason.isin(*CONDITIONAL_REVIEW) & (retweets >= 3)), F.lit(False))


def review_priority(reason: Column, retweets: Column, suspicious: Column) -> Column:
    return F.when(suspicious | F.coalesce(reason.isin(*ALWAYS_REVIEW), F.lit(False)) | (retweets >= 10), "high").when(retweets >= 5, "medium").otherwise("normal")
