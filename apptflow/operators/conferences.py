"""Conference and user snapshots landed as JSON pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptflow import config
from apptflow.functions.text import label, owner_name, topic_phone
from apptflow.operators.chains import chain_positions
from apptflow.operators.joins import smallest_per_key

RIGHTS = (
    "chat_send",
    "chat_rcv",
    "slide_show_send",
    "slide_show_rcv",
    "white_board_send",
    "white_board_rcv",
    "file_transfer_send",
    "file_transfer_rcv",
    "desktop_sharing",
    "recording",
    "audio_send",
    "audio_rcv",
    "video_send",
    "video_rcv",
)
RIGHTS_TYPE = "struct<" + ", ".join(f"{r}: boolean" for r in RIGHTS) + ">"
NAMED_TYPE = "array<struct<id: string, display_name: string>>"
SCHEDULE_TYPE = (
    "struct<type: int, start_time: bigint, duration: bigint, days: array<string>, time: string, time_offset: int>"
)
CONFERENCE_TYPE = (
    "struct<id: string, topic: string, description: string, owner: string, type: int, "
    f"invitations: {NAMED_TYPE}, max_podiums: int, max_participants: int, schedule: {SCHEDULE_TYPE}, "
    f"allow_guests: boolean, rights: map<string, {RIGHTS_TYPE}>, auto_invite: int, url: string, "
    "webclient_url: string, state: string, tags: array<string>, recording: int>"
)
CONFERENCE_PAGE = f"struct<cnt: bigint, conferences: array<{CONFERENCE_TYPE}>>"
# the account's password field is left out on purpose
USER_TYPE = (
    "struct<id: string, uid: string, avatar: string, login_name: string, email: string, "
    "display_name: string, first_name: string, last_name: string, company: string, "
    f"groups: {NAMED_TYPE}, mobile_phone: string, work_phone: string, home_phone: string, "
    "status: int, is_active: int>"
)
USER_PAGE = f"struct<next_page_id: bigint, users: array<{USER_TYPE}>>"
# a user's position: the page, then the place on it; pages may have any size
PAGE_BITS = 32
POSITIONS_PER_BLOCK = 500 << PAGE_BITS


def conferences(pages: DataFrame) -> DataFrame:
    """All conference records of ``pages`` (``page_id``, ``body``), every field."""
    parsed = pages.select(F.from_json("body", CONFERENCE_PAGE).alias("p"))
    return parsed.select(F.explode("p.conferences").alias("c")).select("c.*")


def conference_snapshot(pages: DataFrame) -> DataFrame:
    """Conferences with readable type, owner and the phone in the topic."""
    return conferences(pages).select(
        "id",
        "topic",
        owner_name(F.col("owner")).alias("owner"),
        topic_phone(F.col("topic")).alias("topic_phone"),
        label(F.col("type"), config.CONFERENCE_TYPES, "unknown").alias("type"),
        F.timestamp_seconds("schedule.start_time").cast("timestamp_ntz").alias("starts_at"),
        "state",
    )


def snapshot_completeness(pages: DataFrame) -> DataFrame:
    """One row: records announced by the source, records landed, pages unreadable."""
    p = pages.select(F.from_json("body", CONFERENCE_PAGE).alias("p"))
    return p.agg(
        F.max("p.cnt").alias("announced"),
        F.sum(F.coalesce(F.array_size("p.conferences"), F.lit(0))).alias("landed"),
        F.count_if(F.col("p.cnt").isNull()).alias("unreadable"),
    )


def user_snapshot(pages: DataFrame) -> DataFrame:
    """Users with their position in the list the service returns.

    A page without a number has no place in the list: it fails the job.
    """
    number = F.coalesce(
        F.col("page_id"), F.raise_error("a user page without a number").cast("bigint")
    )
    parsed = pages.select(number.alias("page_id"), F.from_json("body", USER_PAGE).alias("p"))
    return parsed.select("page_id", F.posexplode("p.users").alias("n", "u")).select(
        (F.shiftleft(F.col("page_id").cast("bigint"), PAGE_BITS) + F.col("n")).alias("list_pos"), "u.*"
    )


def page_chain(pages: DataFrame, first_page: int = 0) -> DataFrame:
    """Where each landed page stands in the list the service returns page by page.

    Columns: page_id, next_page_id, place (from 0, null where following ``next_page_id``
    from the first page does not lead), part, on_cycle; see ``chains.chain_positions``.
    """
    next_page = F.from_json("body", "struct<next_page_id: bigint>")["next_page_id"]
    links = pages.select(F.col("page_id").alias("id"), next_page.alias("next_id"))
    return chain_positions(links, first_page).select(
        F.col("id").alias("page_id"), F.col("next_id").alias("next_page_id"), "place", "part", "on_cycle"
    )


def user_chain_positions(pages: DataFrame, first_page: int = 0) -> DataFrame:
    """Users with their position in the order the service lists them.

    The service hands out pages along ``next_page_id``, so that, and not the page's
    number, gives the position. Users on pages that the chain does not reach have a null
    position: they come last wherever positions are ranked. Of a page that landed twice
    one body counts.
    """
    landed = smallest_per_key(pages.select("page_id", "body").where(F.col("page_id").isNotNull()), ["page_id"])
    places = page_chain(landed, first_page).select("page_id", "place")
    parsed = landed.select("page_id", F.from_json("body", USER_PAGE).alias("p")).join(places, "page_id")
    return parsed.select("place", F.posexplode("p.users").alias("n", "u")).select(
        (F.shiftleft(F.col("place"), PAGE_BITS) + F.col("n")).alias("list_pos"), "u.*"
    )


def user_snapshot_completeness(pages: DataFrame, first_page: int = 0) -> DataFrame:
    """One row: pages landed, whether the first one is missing, pages unreadable,
    pages some other page points to that are missing, and pages that end the chain."""
    p = pages.select("page_id", F.from_json("body", USER_PAGE).alias("p"))
    own = p.agg(
        F.count("*").alias("pages"),
        (F.count_if(F.col("page_id") == first_page) == 0).alias("first_missing"),
        F.count_if(F.col("page_id").isNull() | F.col("p.next_page_id").isNull() | F.col("p.users").isNull()).alias(
            "unreadable"
        ),
        F.count_if(F.col("p.next_page_id") == -1).alias("ends"),
    )
    gaps = page_chain_gaps(pages).agg(F.count_distinct("missing_page").alias("n")).scalar()
    return own.withColumn("missing", F.coalesce(gaps, F.lit(0)))


def page_chain_gaps(pages: DataFrame) -> DataFrame:
    """Pages some other page points to that were not landed."""
    links = pages.select(
        F.col("page_id").alias("from_page"),
        F.from_json("body", "struct<next_page_id: bigint>")["next_page_id"].alias("page_id"),
    ).where(F.col("page_id") != -1)
    return links.join(pages.select("page_id"), "page_id", "left_anti").select(
        F.col("page_id").alias("missing_page"), "from_page"
    )
