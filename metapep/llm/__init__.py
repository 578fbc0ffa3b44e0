"""Operations of a training-data pipeline over text corpora. Nothing outside this subpackage imports it."""
