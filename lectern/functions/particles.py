"""Korean particles: choice by the stem's final consonant, and expansion of replace pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import final_consonant, is_expandable_stem

# Forms after a final consonant, after none, and after the consonant rieul.
PARTICLES = (
    ("은", "는", "은"),
    ("이", "가", "이"),
    ("을", "를", "을"),
    ("과", "와", "과"),
    ("으로", "로", "로"),
    ("의", "의", "의"),
    ("에", "에", "에"),
    ("도", "도", "도"),
    ("고", "고", "고"),
    ("만", "만", "만"),
    ("한테", "한테", "한테"),
    ("이나", "나", "이나"),
    ("이에요", "예요", "이에요"),
    ("이죠", "죠", "이죠"),
    ("이니까", "니까", "이니까"),
    ("이잖아요", "잖아요", "이잖아요"),
    ("이면", "면", "이면"),
    ("이면은", "면은", "이면은"),
    ("이라고요", "라고요", "이라고요"),
    ("이라든지", "라든지", "이라든지"),
    ("이든지", "든지", "이든지"),
)
RIEUL = 8


def with_particle(stem: Column, forms) -> Column:
    """The form of a particle that the stem takes; forms is a triple or a struct of three."""
    closed, open_, rieul = (F.lit(x) for x in forms) if isinstance(forms, tuple) else (forms["closed"], forms["open"], forms["rieul"])
    end = final_consonant(stem)
    return F.when(end == RIEUL, rieul).when(end > 0, closed).otherwise(open_)


def _specs() -> Column:
    return F.array(*(F.struct(F.lit(a).alias("closed"), F.lit(b).alias("open"), F.lit(c).alias("rieul")) for a, b, c in PARTICLES))


def _ends_in(word: Column, spec: Column) -> Column:
    """Whether some stem of two characters or more takes the particle and makes the word."""
    cuts = F.filter(F.sequence(F.lit(2), F.greatest(F.length(word) - 1, F.lit(2))), lambda k: k < F.length(word))
    return F.exists(cuts, lambda k: F.substring(word, k + 1, F.length(word)) == with_particle(F.substring(word, F.lit(1), k), spec))


def is_particle_variant(wrong: Column, right: Column) -> Column:
    """Whether one particle explains the ends of both sides."""
    return F.exists(_specs(), lambda s: _ends_in(wrong, s) & _ends_in(right, s))


def forms_of(pairs: DataFrame) -> DataFrame:
    """(seq, k, wrong, right, base_wrong, base_right) of pairs (seq, wrong, right): each pair (k 0) and its forms with each particle.

    The particle of either side is chosen by that side's stem.
    """
    fits = is_expandable_stem(F.col("wrong")) & is_expandable_stem(F.col("right")) & ~is_particle_variant(F.col("wrong"), F.col("right"))
    forms = F.transform(_specs(), lambda s: F.struct(F.concat("wrong", with_particle(F.col("wrong"), s)).alias("w"), F.concat("right", with_particle(F.col("right"), s)).alias("r")))
    own = F.array(F.struct(F.col("wrong").alias("w"), F.col("right").alias("r")))
    rows = pairs.select("seq", F.col("wrong").alias("base_wrong"), F.col("right").alias("base_right"), F.posexplode(F.concat(own, F.when(fits, forms).otherwise(F.array().cast("array<struct<w:string,r:string>>")))).alias("k", "x"))
    return rows.select("seq", "k", F.col("x.w").alias("wrong"), F.col("x.r").alias("right"), "base_wrong", "base_right")


def expand_pairs(pairs: DataFrame) -> DataFrame:
    """(seq, wrong, right) to (ord, wrong, right, base_wrong, base_right): pairs and their forms in order, each once.

    A pair met again keeps its first place and base.
    """
    rows = forms_of(pairs)
    first = F.row_number().over(Window.partitionBy("wrong", "right").orderBy("seq", "k"))
    return rows.withColumn("first", first).where("first = 1").select((F.col("seq") * (len(PARTICLES) + 1) + F.col("k")).alias("ord"), "wrong", "right", "base_wrong", "base_right")
