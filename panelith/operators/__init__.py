"""Panel, quality, sample, preprocessing, evaluation, comparison, radar and news operators."""
