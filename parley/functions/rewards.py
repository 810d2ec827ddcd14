"""Rewards of completions as column expressions; a null completion has no reward."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.bind import bound


def format_reward(completion: Column) -> Column:
    """1 if the text is '<think>...</think>', blanks, '<answer>...</answer>' and nothing else."""
    return F.when(completion.isNotNull(), completion.rlike(r"(?s)\A<think>.*?</think>\s*<answer>.*?</answer>\z").cast("double"))


def react_format_reward(completion: Column) -> Column:
    """1 if the text is '<think>...</think>', then 'Action:' and later 'Action Input:'."""
    return F.when(completion.isNotNull(), completion.rlike(r"(?s)\A<think>.*?</think>\s*Action:.*?Action Input:").cast("double"))


def cosine_reward(
    length: Column, correct: Column, max_length: int, correct_range: tuple[float, float] = (1.0, 0.5), wrong_range: tuple[float, float] = (-1.0, -0.5)
) -> Column:
    """From the first to the second value of the range along half a cosine, as the length goes to ``max_length``."""

    def along(first: float, last: float) -> Column:
        return F.lit(last) + F.lit((first - last) / 2) * (F.lit(1.0) + F.cos(F.lit(math.pi) * F.least(length, F.lit(max_length)) / F.lit(float(max_length))))

    return F.when(correct, along(*correct_range)).otherwise(along(*wrong_range))


def repetition_reward(completion: Column, n: int = 3, max_penalty: float = -1.0) -> Column:
    """``max_penalty`` times the share of repeated word n-grams; 0 with fewer than n words. N-grams are told apart by 64 bits of hash."""
    words = F.filter(F.split(F.lower(completion), r"\s+"), lambda w: w != "")

    def of(held: Column) -> Column:
        count = F.size(held) - (n - 1)
        # words are hashed once, not once for each n-gram that they are in
        grams = F.transform(F.slice(held, F.lit(1), F.greatest(count, F.lit(0))), lambda _, i: F.xxhash64(*[F.get(held, i + k) for k in range(n)]))
        share = F.lit(1.0) - F.size(F.array_distinct(grams)) / count
        return F.when(count >= 1, share * F.lit(max_penalty)).otherwise(F.lit(0.0))

    return F.when(completion.isNotNull(), bound(F.transform(words, lambda w: F.xxhash64(w)), of))


def overlong_reward(length: Column, max_length: int, cache: int) -> Column:
    """0 up to ``max_length - cache``, then falling to -1 at ``max_length`` and on."""
    return F.least(-(length - F.lit(max_length - cache)) / F.lit(float(cache)), F.lit(0.0))


def boxed_answer(text: Column) -> Column:
    """Content of the last '\\\\boxed{...}' without inner braces, blanks taken out; null if there is none."""
    found = F.regexp_extract_all(F.substring_index(text, "# Answer", 1), F.lit(r"\\boxed\{([^{}]*)\}"), F.lit(1))
    return F.when(F.size(found) > 0, F.regexp_replace(F.element_at(found, -1), r"\s+", ""))


def math_reward(completion: Column, solution: Column) -> Column:
    """1 if both texts box the same string; symbolic equality isn't judged."""
    return F.coalesce((boxed_answer(completion) == boxed_answer(solution)).cast("double"), F.lit(0.0))


def judged_reward(judgement: Column) -> Column:
    """The number from 0 to 1 after 'Reward:' in a judge's answer; null if there is none."""
    return F.regexp_extract(judgement, r"Reward:\s*([0-1](?:\.\d+)?)", 1).try_cast("double")


#: Reward functions of a completion alone, by name.
REWARDS = {"format": format_reward, "react_format": react_format_reward, "repetition": repetition_reward}


# Fixed value: what leads a judge to a number.
JUDGE_PROMPT = "Reward: "


def judge_prompt(query: Column, response: Column, truth: Column | None = None) -> Column:
    """What a judge of steps is asked: the question, a reference answer if there is one, the response, and where the number goes."""
    reference = F.lit("") if truth is None else F.when(truth.isNotNull(), F.concat(F.lit("The reference answer is:\n"), truth, F.lit("\n"))).otherwise("")
    return F.concat(F.lit("The question is:\n"), query, F.lit("\n"), reference, F.lit("The response is:\n"), response, F.lit(f"\nGive your score after '{JUDGE_PROMPT}'."))


def process_reward(judgement: Column) -> Column:
    """The number between the first 'Reward:' of a judge's answer and the next one or the end, asterisks left out; 0 where there is none."""
    after = F.replace(F.get(F.split(judgement, "Reward:"), F.lit(1)), F.lit("*"), F.lit(""))
    number = F.regexp_extract(after, r"^\s*([-+]?(?:\d+\.?\d*|\.\d+))\s*$", 1)
    return F.when(F.contains(judgement, F.lit("Reward:")), F.coalesce(number.try_cast("double"), F.lit(0.0))).otherwise(F.lit(0.0))
