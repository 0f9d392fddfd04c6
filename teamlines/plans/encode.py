"""Feature columns to vectors, as pipeline stages that can be saved with a model."""

from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.operators.catalog import CATEGORICAL

def category_levels(train: DataFrame, columns) -> dict:
    """The training values of each categorical column in alphabetical order.

    They are the names of columns of the result, so the driver has to know them all: one
    value per distinct category, never more than the model has inputs.
    """
    levels = {}
    for c in columns:
        found = train.select(c).where(F.col(c).isNotNull()).distinct().collect()
        levels[c] = sorted(row[0] for row in found)
    return levels


def indicator_columns(levels: dict) -> dict:
    """0/1 columns for all but the first value; an unknown value gives all zeros."""
    return {
        f"{c}_{v}": F.when(F.col(c) == v, 1).otherwise(0) for c, values in levels.items() for v in values[1:]
    }


def one_hot(df: DataFrame, train: DataFrame, columns=CATEGORICAL) -> DataFrame:
    return df.withColumns(indicator_columns(category_levels(train, columns)))


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def encoding_stages(train: DataFrame, features, missing_flags=False, output="features"):
    """``(stages, names)``: fill numbers with 0, add indicators, assemble.

    ``missing_flags`` adds a 0/1 column per number telling that it was missing. The first input goes over a
    higher-order function: as part of a whole stage, the code of so many columns becomes one method that is too
    long for the JVM to compile and would be interpreted for every row; beside that function it is cut into short ones.
    """
    categorical = [c for c in features if c in CATEGORICAL]
    numbers = [c for c in features if c not in CATEGORICAL]
    columns, names = [], []

    def add(name, sql):
        columns.append(f"{sql if columns else f'element_at(transform(array({sql}), x -> x), 1)'} AS `in_{name}`")
        names.append(name)

    for c in numbers:
        add(c, f"coalesce(CAST(`{c}` AS DOUBLE), 0D)")
    for c, values in category_levels(train, categorical).items():
        for v in values[1:]:
            add(f"{c}_{v}", f"CASE WHEN `{c}` = {_quoted(v)} THEN 1D ELSE 0D END")
    if missing_flags:
        for c in numbers:
            add(f"{c}_missing", f"CASE WHEN `{c}` IS NULL THEN 1D ELSE 0D END")
    filled = SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")
    assembled = VectorAssembler(inputCols=[f"in_{n}" for n in names], outputCol=output)
    return [filled, assembled], names


def drop_inputs(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("in_")])
