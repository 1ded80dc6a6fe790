"""The loads: landing rows in, history table and updated landing flags out."""

from histflow.plans.loads import (
    Load,
    account_structure_load,
    contacts_load,
    customer_load,
    mapped_load,
    product_configuration_load,
    reversion_load,
)

__all__ = [
    "Load",
    "account_structure_load",
    "contacts_load",
    "customer_load",
    "mapped_load",
    "product_configuration_load",
    "reversion_load",
]
