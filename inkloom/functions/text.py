"""Captions, tags, paths, logs and service replies as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes of image files (fixed values).
IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "webp", "bmp")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/\\]*$", 0)


def suffix(path: Column) -> Column:
    """What follows a name's last dot, in lower case; a dot that starts the name doesn't count."""
    return F.lower(F.regexp_extract(file_name(path), r"[^.].*\.([^.]+)$|^[^.]\.([^.]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def is_image(path: Column) -> Column:
    return suffix(path).isin(*IMAGE_SUFFIXES)


def one_line(text: Column) -> Column:
    """White space of any kind as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def normalize_caption(text: Column, trigger: Column) -> Column:
    """One line that starts with the trigger and a comma; a trigger that is there already, in any case, is not doubled."""
    line = one_line(text)
    rest = F.when(F.startswith(F.lower(line), F.lower(trigger)), F.ltrim(F.substr(line, F.char_length(trigger) + 1), F.lit(" ,"))).otherwise(line)
    return F.rtrim(F.concat(trigger, F.lit(", "), rest))


def build_caption(trigger: Column, tags: Column) -> Column:
    """The trigger, then the tags once each in their order; a tag that is the trigger in any case is left out."""
    kept = F.filter(F.array_distinct(tags), lambda t: F.lower(t) != F.lower(trigger))
    return F.when(F.size(kept) > 0, F.concat(trigger, F.lit(", "), F.array_join(kept, ", "))).otherwise(trigger)


def select_tags(probabilities: Column, names: Column, general: Column, least: float) -> Column:
    """Names of the general tags whose probability is at least ``least``; the arrays go by position."""
    rows = F.arrays_zip(probabilities.alias("p"), names.alias("n"), general.alias("g"))
    return F.transform(F.filter(rows, lambda r: r["g"] & (r["p"].cast("double") >= least)), lambda r: r["n"])


def comma_list(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda v: F.trim(v)), lambda v: v != "")


#: Fields of a captioning service's reply (fixed values).
REPLY = "caption string, in_tokens bigint, out_tokens bigint, latency_s double, error string, detail string"


def service_reply(raw: Column) -> Column:
    """A reply's fields, or ``error`` set. The fields are a JSON object, or one inside a JSON string, either by itself or
    as the first entry of a list; an empty list has no fields.

    Null or blank: ``empty_response``; anything else that is not such a reply: ``parse_failed``. It is parsed once a row.
    """
    line = F.trim(raw)
    whole = F.when(F.startswith(line, F.lit("[")), line).otherwise(F.concat(F.lit("["), line, F.lit("]")))
    inner = F.when(F.get_json_object(whole, "$[0]").isNotNull(), F.get_json_object(whole, "$[0]")).when(F.json_array_length(whole) == 0, F.lit("{}"))
    bad = F.when(raw.isNull() | (line == ""), "empty_response").when(F.json_object_keys(inner).isNull(), "parse_failed")
    seen = F.struct(F.from_json(inner, REPLY).alias("reply"), bad.alias("bad"), F.substring(raw, 1, 160).alias("start"))
    none = F.from_json(F.lit("{}"), REPLY)
    return F.get(F.transform(F.array(seen), lambda r: F.when(r["bad"].isNull(), r["reply"]).otherwise(none.withField("error", r["bad"]).withField("detail", F.when(r["bad"] == "parse_failed", r["start"])))), 0)


def last_data_line(stream: Column) -> Column:
    """Of a server's event stream the payload of the last ``data:`` line that is neither empty nor ``null``; else null."""
    payloads = F.transform(F.filter(F.split(stream, "\n"), lambda x: F.startswith(x, F.lit("data:"))), lambda x: F.trim(F.regexp_replace(F.substr(x, F.lit(6)), r"[\r\t]", " ")))
    said = F.filter(payloads, lambda x: (x != "") & (x != "null"))
    return F.when(F.size(said) > 0, F.element_at(said, -1))


def request_body(model: Column, prompt: Column, image: Column) -> Column:
    """What is posted to a captioning service: a JSON object whose ``data`` lists model, prompt and image in base 64, of one line."""
    one_piece = F.replace(F.base64(image), F.lit("\r\n"), F.lit(""))  # Spark may break the line after each 76 characters
    return F.to_json(F.struct(F.array(model, prompt, one_piece).alias("data")))


def url_part(value: Column) -> Column:
    """A value as a part of a URL's query: all but letters, digits and ``_.-~`` is percent-encoded."""
    out = F.url_encode(value)
    for given, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(given), F.lit(wanted))
    return out


#: What a caption describes, by style.
PROMPT_STYLES = {
    "optimal": "Write one line of plain prose, one to three sentences: who is there and how they look, pose and action, clothes, main objects, place, shot and camera angle, light.",
    "rich": "Write three to six sentences of plain prose and leave nothing out: each person's body, hair, face and expression, every garment and object, poses and gestures, what is near and far, the place, shot and camera angle, light.",
}


def caption_prompt(trigger: str, style: str) -> str:
    """What a captioning service is asked for: content alone, so that the trigger stands for the style."""
    if style not in PROMPT_STYLES:
        raise ValueError(f"unknown style {style!r}; there are: {', '.join(PROMPT_STYLES)}")
    return f"Caption this picture for training. Begin with '{trigger}, '. {PROMPT_STYLES[style]} Say nothing of drawing style, medium, line, colour, or of panels, pages and speech bubbles. Answer with the caption alone."


def prompts(content: Column) -> Column:
    """The prompts of a prompt file, an array: its lines without white space of any kind at their ends, blank ones left out."""
    lines = F.split(content, r"[\n-\r\x1C-\x1E\x85\u2028\u2029]+")
    return F.filter(F.transform(lines, lambda x: F.regexp_replace(x, r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")), lambda x: x != "")


def worth_retrying(error: Column) -> Column:
    """Errors that may pass: any but client errors other than too many requests; no error is not one."""
    code = F.coalesce(error, F.lit(""))
    return (code != "") & (~F.startswith(code, F.lit("http_4")) | (code == "http_429"))


def may_pass(error: str) -> bool:
    """As ``worth_retrying``, of one value."""
    return bool(error) and (not error.startswith("http_4") or error == "http_429")


def _number(line: Column, pattern: str, group: int, kind: str) -> Column:
    return F.nullif(F.regexp_extract(line, pattern, group), F.lit("")).try_cast(kind)


def training_progress(line: Column) -> Column:
    """Step, steps, epoch, epochs and loss of a trainer's log line; null for what it doesn't say.

    A line that begins with an epoch says nothing else. Steps are read only beside an ``avr_loss=``, which tells the
    training's bar from those of caching; a loss that is no number is null.
    """
    epoch = r"^epoch (\d+)/(\d+)"
    is_epoch, is_bar = line.rlike(epoch), F.contains(line, F.lit("avr_loss=")) & line.rlike(r"\d+/\d+\s*\[")

    def bar(pattern: str, group: int, kind: str) -> Column:
        return F.when(~is_epoch & is_bar, _number(line, pattern, group, kind))

    step = r"(\d+)/(\d+)\s*\["
    return F.struct(
        bar(step, 1, "int").alias("step"),
        bar(step, 2, "int").alias("total_steps"),
        _number(line, epoch, 1, "int").alias("epoch"),
        _number(line, epoch, 2, "int").alias("total_epochs"),
        bar(r"avr_loss=([0-9.eE+\-]+)", 1, "double").alias("loss"),
    )


def progress_fraction(index: Column, total: Column, phase: Column) -> Column:
    """Share of a run that is complete: a running stage doesn't count yet; a run of no stages is complete."""
    done = index - 1 + F.when(phase == "running", 0.0).otherwise(1.0)
    return F.when(total <= 0, 1.0).otherwise(done / total)


def progress_line(index: Column, total: Column, name: Column, phase: Column, produced: Column, detail: Column) -> Column:
    said = (
        F.when(phase == "running", "running")
        .when(phase == "done", F.concat(F.lit("done ("), produced.cast("string"), F.lit(" produced)")))
        .when(phase == "skipped", F.concat(F.lit("skipped ("), detail, F.lit(")")))
        .otherwise(F.concat(F.lit("error: "), detail))
    )
    return F.format_string("[%d/%d] %s: %s", index, total, name, said)


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    """Each ``%KEY%`` of a template replaced by its value."""
    for key, value in values.items():
        template = F.replace(template, F.lit(f"%{key}%"), value)
    return template
