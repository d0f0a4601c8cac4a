"""Query of the near copies."""

from scoreloom.llm.minhash import Likeness, linked
from scoreloom.llm.register import documents, register

CONTRACT = Likeness(words=3, percent=85)


@register("op3_minhash")
def op3_minhash(spark, folder):
    return linked(documents(spark, folder), CONTRACT)
