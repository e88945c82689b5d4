"""All registered queries; importing the parts registers them."""

from lodeflow.plans import catalog_boxes, catalog_coordinates, catalog_core, catalog_documents, catalog_routes, catalog_text  # noqa: F401
