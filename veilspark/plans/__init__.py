"""The jobs: operators put together the way a study runs through them."""
