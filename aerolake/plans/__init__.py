"""Operations on stored Parquet tables."""
