import pytest
from pyspark.sql import types as T

from contractflow import Column, Contract, ContractError
from contractflow.contract import published_document, source_type, spark_type

DOCUMENT = {
    "version": "1.0.0",
    "schema": [
        {
            "name": "orders",
            "properties": [
                {"name": "order_id", "physicalType": "BIGINT", "required": True, "primaryKey": True},
                {"name": "order_status", "physicalName": "status", "physicalType": "STRING"},
                {"name": "amount", "physicalType": "DECIMAL(10, 2)"},
            ],
        }
    ],
}


def test_documents_become_typed_columns():
    contract = Contract.from_dict(DOCUMENT)
    assert (contract.table, contract.version, contract.keys) == ("orders", "1.0.0", ["order_id"])
    assert contract.names == ["order_id", "order_status", "amount"]
    assert contract.resolve(["status"]) == ["order_status"]
    assert contract.schema()["amount"].dataType == T.DecimalType(10, 2)
    assert contract.schema()["order_status"].metadata == {"physicalName": "status", "key": False}
    assert contract.read_schema("json").names == ["order_id", "status", "amount"]
    assert contract.published().columns[1] == Column("order_status", "STRING")
    assert "physicalName" in DOCUMENT["schema"][0]["properties"][1]
    assert "physicalName" not in published_document(DOCUMENT)["schema"][0]["properties"][1]
    assert Contract.from_yaml("version: '1.0.0'\nschema:\n- name: t\n  properties:\n  - {name: a, physicalType: INT}\n").names == ["a"]


def test_timestamps_have_no_zone_and_unknown_types_are_refused():
    assert spark_type("TIMESTAMP") == T.TimestampNTZType()
    assert spark_type("integer") == T.IntegerType()
    for bad in ["ARRAY<INT>", "DECIMAL(39,0)", "DECIMAL(2,3)", "MAP<STRING,INT>", ""]:
        with pytest.raises(ContractError):
            spark_type(bad)
    assert source_type("NVARCHAR") == "STRING"
    with pytest.raises(ContractError):
        source_type("geography")


@pytest.mark.parametrize(
    "columns",
    [
        [Column("a", "INT"), Column("A", "INT")],
        [Column("a", "INT", target="x"), Column("b", "INT", target="X")],
        [Column("__start_at", "INT")],
        [Column("a", "INT", target="__END_AT")],
        [Column("_rescued_data", "STRING")],
        [Column("1a", "INT")],
        [Column("a b", "INT")],
    ],
)
def test_names_are_simple_distinct_and_not_reserved(columns):
    with pytest.raises(ContractError):
        Contract("t", tuple(columns))


def test_swapped_names_are_allowed():
    Contract("t", (Column("left", "BIGINT", target="right"), Column("right", "STRING", target="left")))


def test_history_contract_loses_keys_and_gains_bounds():
    schema = Contract.from_dict(DOCUMENT).history_schema(T.DateType(), drop=["amount"])
    assert schema.names == ["order_id", "order_status", "__START_AT", "__END_AT"]
    assert not schema["order_id"].metadata["key"]
    assert (schema["__START_AT"].nullable, schema["__END_AT"].nullable) == (False, True)
    assert schema["__END_AT"].dataType == T.DateType()


def test_same_shape_compares_version_names_and_types():
    contract = Contract.from_dict(DOCUMENT)
    assert contract.same_shape(Contract.from_dict(DOCUMENT))
    assert not contract.same_shape(Contract.from_dict({**DOCUMENT, "version": "2.0.0"}))
    with pytest.raises(ContractError):
        contract.resolve(["nope"])
