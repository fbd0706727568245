"""Models: preprocessing, candidates, comparison, calibration and scoring."""
