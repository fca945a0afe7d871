"""Scalar text, URL and JSON functions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Title words that drop a record, and those that keep it all the same.
SKIP_WORDS = [
    "commission", "board", "authority", "jlarc", "vrs", "crime commission", "code commission", "civic education", "manufacturing development", "small business commission",
    "health insurance reform commission", "recurrent flooding", "mei project approval commission", "public hearing",
]
KEEP_WORDS = ["session", "floor"]
# Role words that are no names.
ROLE_WORDS = [
    "staff", "attorney", "counsel", "clerk", "director", "manager", "assistant", "secretary", "chair", "chairman", "chairwoman", "vice", "president", "officer", "coordinator", "analyst",
    "advisor", "administrator", "executive", "chief", "commissioner", "committee", "subcommittee", "member", "representative",
]
# Messages of downloads that never succeed, of those that may, and the reasons shown.
PERMANENT = ["sign in to confirm", "video unavailable", "this video is private", "this video has been removed", "http error 403", "http error 404", "this video is no longer available", "file is too small"]
TRANSIENT = ["timeout", "timed out", "connection refused", "connection reset", "network is unreachable", "could not resolve host", "ssl", "certificate"]
REASONS = [("sign in to confirm", "Bot detection"), ("video unavailable", "Video unavailable"), ("removed", "Video unavailable"), ("private", "Private video"), ("403", "Access forbidden"), ("404", "Video not found"), ("too small", "Invalid download")]
MEDIA_HOST = "https://video.example.org"


def _any(text: Column, words: list[str]) -> Column:
    low = F.lower(text)
    hit = F.lit(False)
    for w in words:
        hit = hit | low.contains(w)
    return hit


def keep_title(title: Column) -> Column:
    """Empty titles are kept; others unless a skip word stands in them without a keep word."""
    t = F.coalesce(title, F.lit(""))
    return (t == "") | ~_any(t, SKIP_WORDS) | _any(t, KEEP_WORDS)


def normalize_title(title: Column) -> Column:
    """The first part of a title cut at dashes that is no clock time, room or adjournment,
    a date in front left out; the trimmed title if no part is left."""
    parts = F.filter(F.transform(F.split(title, r"\s*-\s*"), lambda x: F.trim(x)), lambda x: x != "")
    dated = F.get(parts, F.lit(0)).rlike(r"^[A-Za-z]+\s+\d{1,2},\s+\d{4}$")
    parts = F.when(dated, F.slice(parts, F.lit(2), F.size(parts))).otherwise(parts)
    drop = r"\b\d{1,2}:\d{2}\s*(?:am|pm|m\.?)|adjournment|^sr\s+[a-z]\b|^sr\s*\d+"
    return F.coalesce(F.get(F.filter(parts, lambda x: ~F.lower(x).rlike(drop)), F.lit(0)), F.trim(title))


def is_role(text: Column) -> Column:
    return _any(text, ROLE_WORDS)


def failure_kind(message: Column) -> Column:
    """permanent or transient; the permanent list counts first and is the default."""
    return F.when(_any(message, PERMANENT), "permanent").when(_any(message, TRANSIENT), "transient").otherwise("permanent")


def failure_reason(message: Column) -> Column:
    """A short reason for a failed download."""
    got = F.lit("Download failed")
    for word, reason in reversed(REASONS):
        got = F.when(F.lower(message).contains(word), reason).otherwise(got)
    return got


def url_kind(url: Column) -> Column:
    low = F.lower(url)
    return (
        F.when(low.contains("youtube.com") | low.contains("youtu.be"), "youtube")
        .when(low.contains("granicus") & low.endswith(".mp4"), "granicus")
        .when(low.endswith(".m3u8"), "hls")
        .otherwise("direct")
    )


def youtube_id(url: Column) -> Column:
    """The video id of a watch, short or embed address."""
    return F.nullif(F.regexp_extract(url, r"(?:[?&]v=|youtu\.be/|/embed/)([A-Za-z0-9_-]{11})", 1), F.lit(""))


def screenshot_url(directory: Column, frame: Column, host: str = MEDIA_HOST) -> Column:
    """Address of a frame: host, directory without slashes at its ends, frame with .jpg."""
    name = F.when(F.endswith(frame, F.lit(".jpg")), frame).otherwise(F.concat(frame, F.lit(".jpg")))
    return F.concat_ws("/", F.lit(host), F.regexp_replace(directory, r"^/+|/+$", ""), name)


def manifest_url(directory: Column, host: str = MEDIA_HOST) -> Column:
    """Address of a capture directory's manifest; absolute addresses pass."""
    d = F.regexp_replace(F.regexp_replace(directory, r"/+$", ""), r"/full$", "")
    local = F.concat(F.lit(host), F.regexp_replace(d, r"^/video/", "/"), F.lit("/manifest.json"))
    return F.when(directory.startswith("https://"), F.concat(d, F.lit("/manifest.json"))).otherwise(local)


def storage_key(chamber: Column, committee: Column, day: Column) -> Column:
    """chamber/floor/YYYYMMDD.mp4, or chamber/committee/<short>/YYYYMMDD.mp4."""
    place = F.when(committee.isNull() | (committee == ""), F.lit("floor")).otherwise(F.concat(F.lit("committee/"), F.lower(committee)))
    return F.concat(F.concat_ws("/", chamber, place, F.date_format(day, "yyyyMMdd")), F.lit(".mp4"))


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def archive_identifier(chamber: Column, day: Column, title: Column, prefix: str = "rs", most: int = 80) -> Column:
    """prefix-chamber-date-slug of at most ``most`` characters without a trailing dash."""
    full = F.concat_ws("-", F.lit(prefix), F.lower(chamber), day.cast("string"), slug(title))
    return F.regexp_replace(F.substring(full, 1, most), r"-+$", "")


def archive_title(chamber: Column, title: Column, day: Column) -> Column:
    return F.concat(F.initcap(F.lower(chamber)), F.lit(": "), title, F.lit(", "), F.date_format(day, "MMMM d, yyyy"))


def sanitize(text: Column) -> Column:
    """Valid UTF-8 without NUL and code points beyond the basic plane."""
    return F.regexp_replace(F.make_valid_utf8(text), r"[\x00\x{10000}-\x{10FFFF}]", "")


def speaker_name(text: Column) -> Column:
    """A caption's name: odd marks to spaces, digits to letters, leading titles off; NULL under three letters."""
    t = F.translate(F.regexp_replace(text, r"[^A-Za-z0-9 .'-]", " "), "01", "OI")
    t = F.trim(F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r"(?i)^\s*(?:(?:delegate|del\.?|senator|sen\.?|chair|rep\.?)\s+)+", ""))
    return F.when(F.length(F.regexp_replace(t, "[^A-Za-z]", "")) >= 3, t)


def event_type(title: Column) -> Column:
    """subcommittee before floor before committee; anything else is floor."""
    t = F.lower(title)
    return F.when(t.rlike(r"sub-?committee|subcmte|\bsub\b"), "subcommittee").when(t.rlike(r"\b(session|floor|chamber)\b"), "floor").when(t.contains("committee"), "committee").otherwise("floor")


def strip_suffix_tag(title: Column) -> Column:
    return F.trim(F.regexp_replace(title, r"\s*\[[^\]]*\]\s*$", ""))


def archive_page_id(url: Column) -> Column:
    """The identifier in an archive's details or download address; NULL for others."""
    return F.nullif(F.regexp_extract(url, r"/(?:details|download)/([^/?#]+)", 1), F.lit(""))


def archive_download(host: str, identifier: Column, name: Column) -> Column:
    """Address of a file of an archived item; the name is escaped but for its slashes."""
    escaped = F.regexp_replace(F.regexp_replace(F.url_encode(name), r"\+", "%20"), "%2F", "/")
    escaped = F.replace(F.replace(escaped, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.concat(F.lit(f"{host}/download/"), identifier, F.lit("/"), escaped)


def video_key(url: Column) -> Column:
    """The storage key in an address: its path after the host without the leading slash."""
    return F.regexp_replace(F.regexp_replace(url, r"^[a-z]+://[^/]*", ""), r"^/+", "")


def percentage(part: Column, total: Column) -> Column:
    """part of total as a text of one decimal; 0.0% of nothing."""
    return F.when(F.coalesce(total, F.lit(0)) == 0, "0.0%").otherwise(F.concat(F.format_string("%.1f", F.round(100.0 * part / total, 1)), F.lit("%")))


def any_youtube_id(record: Column) -> Column:
    """The video id of a scraped JSON record: its field, else from the addresses it holds."""
    at = lambda k: F.nullif(F.get_json_object(record, f"$.{k}"), F.lit(""))
    return F.coalesce(at("youtube_id"), youtube_id(at("embed_url")), youtube_id(at("video_url")), youtube_id(at("youtube_url")))


def archive_details(chamber: Column, committee: Column, title: Column, day: Column, place: str = "") -> Column:
    """STRUCT<title, subject, description> of an archived recording."""
    body = F.coalesce(F.nullif(committee, F.lit("")), F.lit("Floor session"))
    when = F.date_format(day, "MMMM d, yyyy")
    subject = F.array_compact(F.array(F.nullif(F.lit(place), F.lit("")), F.initcap(F.lower(chamber)), body))
    text = F.concat_ws(" ", F.concat(F.initcap(F.lower(chamber)), F.lit(",")), F.concat(body, F.lit(",")), F.concat(when, F.lit(".")), title)
    return F.struct(archive_title(chamber, title, day).alias("title"), F.concat_ws("; ", subject).alias("subject"), text.alias("description"))
