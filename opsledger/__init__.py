"""Operations analytics, masking and subsetting on Spark."""
