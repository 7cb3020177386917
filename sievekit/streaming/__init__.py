from sievekit.streaming.scoring_stream import changed_inputs, score_stream  # noqa: F401
