"""Evidence operators over DataFrames."""
