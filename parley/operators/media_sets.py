"""Recipes of public sets with images, audio and video: paths, questions and objects, as projections and semi joins.

Files are never opened: whether one exists is told by a table of paths, such as a listing that Spark
has read with its ``binaryFile`` source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.bind import bound, free
from parley.operators.instruction_sets import asked, dialog, said, stripped
from parley.operators.recipes import option_letter, picked, without_prefix

# Questions of the sets.
CAPTION_QUESTION = "What is the caption of this image?"
WASTE_QUESTION = "Task: Classify household waste."
DESCRIBE_QUESTION = "please describe the image."
SPEECH_QUESTION = "语音转文本"
LATEX_QUESTION = "Using LaTeX to perform OCR on the image."
CAPTCHA_QUESTION = "recognize the content."
DETECTION_QUESTION = "Task: Object Detection"
THINKING_SUFFIX = " Output the thinking process in <think> </think> and final answer (number) in <answer> </answer> tags."
PAIRED_QUESTIONS = ["图片中展示了什么", "讲述一下图片中内容", "告诉我里面有什么", "图片内容是啥"]
PROSE_QUESTIONS = ["Give the description of this image.", "Describe this picture", "What is the proper title of this image?"]
PROSE_PREFIX = "This image displays:"
OBJECT_TAG = "<ref-object><bbox>"
# Where a folder's files lie, as (mark in the path, folder, text to replace, its replacement).
FOLDERS = (
    ("coco/", "coco", "coco/", ""),
    ("gqa/", "gqa", "gqa/", ""),
    ("ocr_vqa/", "ocr_vqa", "", ""),
    ("textvqa/", "textvqa", "textvqa/", ""),
    ("VG_100K/", "VG_100K", "vg/", ""),
    ("VG_100K_2/", "VG_100K_2", "vg/", ""),
)
# Categories by number of the COCO and VOC sets.
COCO = (
    "person", "bicycle", "car", "motorcycle", "airplane", "bus", "train", "truck", "boat", "traffic light", "fire hydrant", "stop sign",
    "parking meter", "bench", "bird", "cat", "dog", "horse", "sheep", "cow", "elephant", "bear", "zebra", "giraffe", "backpack", "umbrella",
    "handbag", "tie", "suitcase", "frisbee", "skis", "snowboard", "sports ball", "kite", "baseball bat", "baseball glove", "skateboard",
    "surfboard", "tennis racket", "bottle", "wine glass", "cup", "fork", "knife", "spoon", "bowl", "banana", "apple", "sandwich", "orange",
    "broccoli", "carrot", "hot dog", "pizza", "donut", "cake", "chair", "couch", "potted plant", "bed", "dining table", "toilet", "tv",
    "laptop", "mouse", "remote", "keyboard", "cell phone", "microwave", "oven", "toaster", "sink", "refrigerator", "book", "clock", "vase",
    "scissors", "teddy bear", "hair drier", "toothbrush",
)
VOC = (
    "aeroplane", "bicycle", "bird", "boat", "bottle", "bus", "car", "cat", "chair", "cow", "diningtable", "dog", "horse", "motorbike", "person",
    "pottedplant", "sheep", "sofa", "train", "tvmonitor",
)


def located(path: Column, roots: dict[str, str], folders: tuple = FOLDERS) -> Column:
    """The path under its folder's root; the first folder whose mark it holds counts, and without any it stays."""
    out = None
    for mark, folder, old, new in folders:
        if folder in roots:
            own = F.replace(path, F.lit(old), F.lit(new)) if old else path
            made = F.concat(F.lit(roots[folder].rstrip("/") + "/"), own)
            out = F.when(F.contains(path, F.lit(mark)), made) if out is None else out.when(F.contains(path, F.lit(mark)), made)
    return path if out is None else out.otherwise(path)


def all_existing(df: DataFrame, paths: str, files: DataFrame, file_path: str = "path") -> DataFrame:
    """Rows that have files, all of which are listed. ``paths`` is an array; rows are told apart by a number of their own."""
    row = free("row", df.columns)
    numbered = df.withColumn(row, F.monotonically_increasing_id())
    listed = files.select(F.col(file_path).alias("file")).distinct()
    wanted = numbered.select(F.col(row).alias("of"), F.explode(paths).alias("file"))
    missing = wanted.join(listed, "file", "left_anti").select("of").distinct()
    return numbered.where(F.size(paths) > 0).join(missing, F.col(row) == F.col("of"), "left_anti").drop(row)


def constant_question(df: DataFrame, question: str, response: str, *keep: str) -> DataFrame:
    """The same question for each row."""
    return asked(df, F.lit(question), F.col(response), *keep)


def random_question(df: DataFrame, questions: list[str], key: str, response: str, *keep: str, prefix: str = "", seed: int = 42) -> DataFrame:
    """One of the questions, by a hash of the key; a prefix of the response goes."""
    answer = F.col(response)
    if prefix:
        answer = F.when(F.startswith(answer, F.lit(prefix)), stripped(without_prefix(answer, prefix))).otherwise(answer)
    return asked(df, picked(questions, F.col(key), seed), answer, *keep)


def dense_caption(text: Column, field: str = "global_caption") -> Column:
    """A field of an object written as a literal with single or double quotes."""
    return F.coalesce(F.get_json_object(text, f"$.{field}"), F.from_json(text, f"{field} string", {"allowSingleQuotes": "true"})[field])


def spoken(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """A transcript without its blanks."""
    return asked(df, F.lit(SPEECH_QUESTION), F.replace(F.col(text), F.lit(" "), F.lit("")), *keep)


def first_caption(df: DataFrame, caption: str, *keep: str) -> DataFrame:
    """Of captions joined by '&&', the first."""
    return asked(df, F.lit(DESCRIBE_QUESTION), F.element_at(F.split(caption, "&&"), 1), *keep)


def options_question(df: DataFrame, query: str, options: str, answer: str, *keep: str, as_label: bool = False) -> DataFrame:
    """The options below the question; the answer, a number from 0, as a letter or as ``label``."""
    whole = F.concat(query, F.lit("\n"), F.array_join(options, "\n"))
    number = F.col(answer).cast("int")
    if as_label:
        return df.select(*keep, F.array(said("user", whole)).alias("messages"), number.alias("label"))
    return asked(df, whole, option_letter(number), *keep)


def first_question(*columns: str) -> Column:
    """The first that is neither null nor the word 'None'."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("None")) for c in columns])


def reference_pairs(df: DataFrame, references: str, *keep: str) -> DataFrame:
    """An image, and its first caption as positive."""
    positive = F.array(F.array(said("user", F.get(F.col(references), F.lit(0)))))
    return df.where(F.size(references) > 0).select(*keep, F.array(said("user", F.lit("<image>"))).alias("messages"), positive.alias("positive_messages"))


def grounded(df: DataFrame, captions: str, bbox: str, *keep: str) -> DataFrame:
    """``objects`` of the first caption and the box, whose numbers are rounded half to even."""
    box = F.transform(bbox, lambda x: F.bround(x.cast("double")).cast("int"))
    return df.select(*keep, F.struct(F.array(F.get(F.col(captions), F.lit(0))).alias("ref"), F.array(box).alias("bbox")).alias("objects"))


def one_of_questions(df: DataFrame, questions: str, answers: str, key: str, *keep: str, seed: int = 42) -> DataFrame:
    """A question and its answer from two arrays, at one place drawn by a hash of the key."""
    pair = F.get(F.arrays_zip(F.col(questions).alias("q"), F.col(answers).alias("a")), F.pmod(F.xxhash64(F.lit(seed), key), F.greatest(F.size(questions), F.lit(1))).cast("int"))
    rows = df.select(*keep, pair.alias("_pair")).where("_pair is not null")
    return rows.select(*keep, dialog(said("user", F.col("_pair")["q"]), said("assistant", F.col("_pair")["a"])).alias("messages"))


def chosen_option(df: DataFrame, question: str, choices: str, answer: str, solution: str, *keep: str) -> DataFrame:
    """The solution, then the choice that the answer, a number from 0, names."""
    return asked(df, F.col(question), F.concat(solution, F.lit("\nSo the final answer is: "), F.get(F.col(choices), F.col(answer).cast("int"))), *keep)


def tagged_spans(caption: Column, spans: Column, tag: str = OBJECT_TAG) -> Column:
    """The caption with each span of ``start`` and ``end`` replaced; spans must not overlap."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def step(held: Column, s: Column) -> Column:
        between = F.substring(caption, held["at"] + 1, s["start"].cast("int") - held["at"])
        return F.struct(F.concat(held["text"], between, F.lit(tag)).alias("text"), s["end"].cast("int").alias("at"))

    last = lambda held: F.concat(held["text"], F.substring(caption, held["at"] + 1, F.lit(2**31 - 1)))
    return F.aggregate(F.array_sort(spans), start, step, last)


def named_objects(df: DataFrame, categories: str, *keep: str, names: tuple = COCO) -> DataFrame:
    """Names of category numbers as ``ref``, and as many tags as answer."""
    ref = bound(F.array(*map(F.lit, names)), lambda all_: F.transform(categories, lambda c: F.get(all_, c.cast("int"))))
    answer = F.array_join(F.transform(categories, lambda c: F.lit(OBJECT_TAG)), "\n")
    return df.select(*keep, dialog(said("user", F.lit(DETECTION_QUESTION)), said("assistant", answer)).alias("messages"), ref.alias("ref"))


def block_text(blocks: Column) -> Column:
    """Text of content blocks of ``type`` and ``text``, with a tag for each image."""
    return F.array_join(F.transform(blocks, lambda b: F.when(b["type"] == "text", b["text"]).when(b["type"] == "image", "<image>").otherwise("")), "")


def thinking_question(df: DataFrame, query: str, response: str, *keep: str) -> DataFrame:
    """The question with the request to think first; the answer is the ``solution`` as well."""
    out = asked(df, F.concat(F.coalesce(query, F.lit("")), F.lit(THINKING_SUFFIX)), F.col(response), *keep, response)
    return out.withColumnRenamed(response, "solution")


def marked_classes(one_hot: Column) -> Column:
    """Numbers of the classes that are marked 1."""
    places = F.transform(one_hot, lambda x, i: F.when(x == 1, i))
    return F.filter(places, lambda i: i.isNotNull())


def rooted(path: Column, root: str) -> Column:
    """A relative path under the root; an absolute one as it is."""
    return F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


#: Share of English among grounding questions, in hundredths.
ENGLISH = 80
# Questions on an object's place, and on what is at a place.
GROUNDING = {
    ("grounding", "en"): ("<ref-object>", "The positions of <ref-object> is", "Find the positions of <ref-object>", "Where is <ref-object>", "Find <ref-object>", "Show me <ref-object>", "Detect <ref-object>", "Locate <ref-object>", "Tell me the location of <ref-object>", "Give the location of <ref-object>", "Provide the bounding box coordinate of <ref-object>"),
    ("grounding", "zh"): ("<ref-object>", "<ref-object>的位置在图片中", "<ref-object>在图片中", "<ref-object>在", "找到<ref-object>的位置", "<ref-object>在哪里", "提供<ref-object>的坐标位置"),
    ("caption", "en"): ("<bbox>", "The object at position <bbox>", "This <bbox> is", "What is the object at <bbox>", "Describe <bbox>", "<bbox> is", "The bounding box coordinate <bbox> contains"),
    ("caption", "zh"): ("<bbox>", "<bbox>是什么", "<bbox>的位置包含", "描述<bbox>", "<bbox>中是", "坐标<bbox>描述了什么", "描述<bbox>中的事物"),
}


def hash_number(key: Column, seed: int, n: int) -> Column:
    """A number below ``n`` from the first digits of md5('seed:key'), which any engine can repeat."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary")), 1, 8)
    return (F.conv(digits, 16, 10).cast("long") % F.lit(n)).cast("int")


def grounding_dialog(df: DataFrame, key: str, task: str, *keep: str, seed: int = 42) -> DataFrame:
    """A question and answer with tags for an object and its box; language and wording by hashes of the key."""
    answer = "<bbox>" if task == "grounding" else "<ref-object>"
    pick = lambda lang: F.get(F.array(*map(F.lit, GROUNDING[task, lang])), hash_number(F.col(key), seed + 1, len(GROUNDING[task, lang])))
    question = F.when(hash_number(F.col(key), seed, 100) < ENGLISH, pick("en")).otherwise(pick("zh"))
    return df.select(*keep, dialog(said("user", question), said("assistant", F.lit(answer))).alias("messages"))
