from fieldspark.functions import exprs  # noqa: F401
