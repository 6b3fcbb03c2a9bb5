"""The three configuration sheets as CSV files."""

from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.operators import catalogue
from auditloom.sources.tables import path_exists

# Sheet headers and the column names used here.
HEADERS = {
    "GeneralConfig": {"Key": "key", "Value": "value"},
    "ModelConfigs": {
        "Version ID": "prompt_version_id",
        "Model Name": "model_name",
        "Thinking Level": "thinking_level",
        "System Instruction Key": "system_key",
        "User Prompt Key": "prompt_key",
        "Enable Code Execution": "code_execution",
    },
    "Materials": {
        "Class": "class",
        "Material": "material",
        "Density": "density",
        "Description": "description",
    },
}


def _sheet(spark, folder, name):
    raw = (
        spark.read.option("header", "true")
        .option("multiLine", "true")
        .option("quote", '"')
        .option("escape", '"')
        .csv(f"{folder}/{name}.csv")
    )
    wanted = [
        (F.col(f"`{head}`") if head in raw.columns else F.lit(None).cast("string")).alias(short)
        for head, short in HEADERS[name].items()
    ]
    # A multi-line CSV file is one partition, so this id follows the rows.
    return raw.select(*wanted, F.monotonically_increasing_id().alias("ord"))


def read_config(spark, folder, fallback=None):
    """(general, models, materials) of a folder.

    When a sheet is missing the fallback folder is read instead; without one
    that is an error.
    """
    missing = [s for s in fixed.SHEETS if not path_exists(spark, f"{folder}/{s}.csv")]
    if missing:
        if fallback is None:
            raise FileNotFoundError(f"Missing required sheets: {missing}")
        return read_config(spark, fallback)
    return tuple(_sheet(spark, folder, s) for s in fixed.SHEETS)


def choose_config(spark, folders, keys=fixed.GENERAL_KEYS):
    """(source, general, models, materials) of the first of `folders` whose sheets are all there and sound.

    Folders without a sheet are passed over; the last folder stands in if no
    other can be used, and must have its sheets.
    """
    whole = [f for f in folders[:-1] if all(path_exists(spark, f"{f}/{s}.csv") for s in fixed.SHEETS)]
    return catalogue.chosen({f: read_config(spark, f) for f in [*whole, folders[-1]]}, keys)


def default_materials(spark):
    """The built-in taxonomy as a sheet; a material describes itself."""
    rows = [(kind, name, str(density), name, i) for i, (kind, name, density) in enumerate(fixed.DEFAULT_MATERIALS)]
    return spark.createDataFrame(rows, "class string, material string, density string, description string, ord bigint")
