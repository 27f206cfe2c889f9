"""Posts of a social network as events: category by terms, a title from the lines, a floor of retweets with a way past it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import times

#: Terms of the categories, markers that need no retweets, signs and brackets at the begin of lines.
EVENT = ("イベント", "開催", "参加方法", "参加条件", "営業", "公演", "集会", "ライブ", "ツアー", "当日join", "ジョイン", "リクイン", "reqin", "request invite")
RECRUITMENT = ("募集", "応募", "締切", "テスター")
STRONG = ("参加方法", "当日join", "開催", "営業", "締切")
DATE_SIGNS = ("🗓", "📅", "⏰")
OPENING, CLOSING = "『「【", "』」】"
RECRUITMENT_TITLE, EVENT_TITLE = "VRChat関連募集", "VRChatイベント"
TAGS = {"recruitment_deadline": ("VRChat", "X", "自動取得", "募集", "締切"), "event": ("VRChat", "X", "自動取得", "イベント")}


def post_category(text: Column) -> Column:
    """recruitment_deadline if it recruits with a deadline or an application, else event if it names one, else null."""
    t = F.coalesce(text, F.lit(""))
    recruits = T.has_any(t, RECRUITMENT) & (F.contains(t, F.lit("締切")) | F.contains(t, F.lit("応募")))
    return F.when(recruits, "recruitment_deadline").when(T.has_any(t, EVENT), "event")


def post_title(text: Column, category: Column, limit: int = 96) -> Column:
    """A line of the post: of a recruitment the first that says so; of an event the first in brackets, else the first without a date.

    Hashtag lines don't count; without such a line the first one, without any line a fixed title.
    """
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\u000b\f\u001c-\u001e\u0085  ]"), lambda x: T.clean_text(x)), lambda x: (x != "") & ~F.startswith(x, F.lit("#")))
    first = F.get(lines, F.lit(0))
    wanted = F.get(F.filter(lines, lambda x: F.contains(x, F.lit("募集")) | F.contains(x, F.lit("応募"))), F.lit(0))
    inside = F.filter(lines, lambda x: F.left(x, F.lit(1)).isin(*OPENING) & F.right(x, F.lit(1)).isin(*CLOSING))
    quoted = F.nullif(F.btrim(F.get(inside, F.lit(0)), F.lit(OPENING + CLOSING)), F.lit(""))
    plain = F.get(F.filter(lines, lambda x: ~x.rlike(r"\p{Nd}{1,2}[/:月日]\p{Nd}{1,2}") & ~T.any_of(F.startswith(x, F.lit(s)) for s in DATE_SIGNS)), F.lit(0))
    line = F.when(category == "recruitment_deadline", F.coalesce(wanted, first, F.lit(RECRUITMENT_TITLE))).otherwise(F.coalesce(quoted, plain, first, F.lit(EVENT_TITLE)))
    return F.when(F.length(line) > limit, F.concat(F.left(line, F.lit(limit)), F.lit("…"))).otherwise(line)


def post_events(posts: DataFrame, min_retweets: int) -> DataFrame:
    """Events from posts that have a date with a clock and a category, and enough retweets or a strong marker.

    posts: id, text, created_at (timestamp), author (null if unknown), retweet_count.
    """
    text = F.trim(F.coalesce("text", F.lit("")))
    df = posts.where((text != "") & F.col("created_at").isNotNull()).withColumns({"_text": text, "category": post_category(text)}).where("category is not null")
    strong = T.has_any(F.col("_text"), STRONG)
    df = df.where((F.coalesce(F.col("retweet_count").cast("long"), F.lit(0)) >= min_retweets) | strong).withColumn("starts_at", times.post_datetime(F.col("_text"), F.col("created_at"))).where("starts_at is not null")
    recruits = F.col("category") == "recruitment_deadline"
    tags = F.when(recruits, F.array(*(F.lit(t) for t in TAGS["recruitment_deadline"]))).otherwise(F.array(*(F.lit(t) for t in TAGS["event"])))
    author = F.nullif(F.col("author"), F.lit(""))
    return df.select(
        F.concat(F.lit("x:"), F.col("id").cast("string")).alias("source_id"), post_title(F.col("_text"), F.col("category")).alias("title"), "starts_at", F.concat(F.lit("@"), author).alias("organizer"),
        F.when(recruits, "オンライン").otherwise("VRChat").alias("location"), T.clean_text(F.col("_text")).alias("description"),
        F.concat(F.lit("https://x.com/"), F.coalesce(author, F.lit("i/web")), F.lit("/status/"), F.col("id").cast("string")).alias("url"), "category", tags.alias("tags"), F.lit(0.82).alias("confidence"), F.lit(False).alias("review_required"),
    )
