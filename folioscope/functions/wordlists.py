"""Stop-word lists.

Both are defaults only: every operator that drops stop words takes the list as a parameter, and
``read_stop_words`` loads a longer one from a text file.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# The widely published English stop list used for cleaning. Entries with an apostrophe are left
# out because cleaning turns apostrophes into blanks before the list is applied, so they can never match.
CLEANING_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
    herself it its itself they them their theirs themselves what which who whom this that these those am is are
    was were be been being have has had having do does did doing a an the and but if or because as until while
    of at by for with about against between into through during before after above below to from up down in out
    on off over under again further then once here there when where why how all any both each few more most
    other some such no nor not only own same so than too very s t can will just don should now d ll m o re ve y
    ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn
    """.split()
)

# Spark's own English list (StopWordsRemover), entries that can equal a token of two or more letters.
VECTOR_STOP_WORDS = tuple(
    """
    me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
    herself it its itself they them their theirs themselves what which who whom this that these those am is are
    was were be been being have has had having do does did doing an the and but if or because as until while
    of at by for with about against between into through during before after above below to from up down in out
    on off over under again further then once here there when where why how all any both each few more most
    other some such no nor not only own same so than too very can will just don should now cannot could ought
    would
    """.split()
)


def read_stop_words(spark: SparkSession, path: str) -> tuple[str, ...]:
    """One word per line. A stop list is a parameter, not data: it is read whole into the plan."""
    words = spark.read.text(path).select(F.lower(F.trim("value")).alias("w")).where("w <> ''").distinct()
    return tuple(sorted(row.w for row in words.collect()))
