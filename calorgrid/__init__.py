"""calorgrid: DataFrame operators for component-level thermal inspection data."""
