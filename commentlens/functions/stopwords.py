"""Stop lists. The two short ones are given here, longer ones are tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The 179 English stopwords of the NLTK corpus.
NLTK_ENGLISH = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves "
    "he him his himself she she's her hers herself it it's its itself they them their theirs themselves "
    "what which who whom this that that'll these those am is are was were be been being have has had having "
    "do does did doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn "
    "mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't "
    "wouldn wouldn't"
).split()

# The 174 English stopwords of the Snowball project.
SNOWBALL_ENGLISH = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is "
    "are was were be been being have has had having do does did doing would should could ought i'm you're he's "
    "she's it's we're they're i've you've we've they've i'd you'd he'd she'd we'd they'd i'll you'll he'll "
    "she'll we'll they'll isn't aren't wasn't weren't hasn't haven't hadn't doesn't don't didn't won't wouldn't "
    "shan't shouldn't can't cannot couldn't mustn't let's that's who's what's here's there's when's where's "
    "why's how's a an the and but if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over under again further then once "
    "here there when where why how all any both each few more most other some such no nor not only own same so "
    "than too very"
).split()

LISTS = {"nltk": NLTK_ENGLISH, "snowball": SNOWBALL_ENGLISH}


def stopword_table(spark: SparkSession, extra: DataFrame | None = None) -> DataFrame:
    """Rows ``(list, word)``; ``extra`` adds lists of the user with the same columns."""
    rows = [(name, word) for name, words in LISTS.items() for word in dict.fromkeys(words)]
    table = spark.createDataFrame(rows, "list STRING, word STRING")
    return table if extra is None else table.unionByName(extra.select("list", "word"))
