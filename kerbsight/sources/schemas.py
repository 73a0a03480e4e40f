"""Schemas of landing documents and of the lifecycle tables."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, DoubleType, MapType, StringType, StructType


def fields(types: dict[str, str | DataType]) -> StructType:
    """A struct of nullable fields."""
    out = StructType()
    for name, kind in types.items():
        out.add(name, kind)
    return out


BOX = fields(dict.fromkeys(("x_center", "y_center", "width", "height"), "float"))
LANDING = fields({
    "image_file_name": "string",
    "image_file_timestamp": "string",
    "gps_data": fields({"latitude": "double", "longitude": "double", "coordinate_time_stamp": "string"}),
    "project": fields({"model_name": "string", "aml_model_version": "integer", "project_version": "string", "customer": "string"}),
    "detections": ArrayType(fields({"object_class": "integer", "confidence": "float", "tracking_id": "integer", "boundingBox": BOX})),
})
FRAMES = fields({
    "frame_id": "long", "image_name": "string", "image_timestamp": "timestamp", "gps_lat": "double", "gps_lon": "double", "gps_timestamp": "timestamp",
    "model_name": "string", "aml_model_version": "integer", "project_version": "string", "customer": "string", "status": "string",
})
DETECTIONS = fields({
    "detection_id": "long", "frame_id": "long", "image_name": "string", "object_class": "integer", "x_center": "float", "y_center": "float",
    "width": "float", "height": "float", "confidence": "float", "tracking_id": "integer", "status": "string",
})
FEEDBACK = fields({"signal_id": "string", "status": "string", "text": "string", "user": "string", "update_time": "timestamp"})
COCO = fields({
    "images": ArrayType(fields({"id": "string", "width": "integer", "height": "integer", "file_name": "string"})),
    "annotations": ArrayType(fields({"id": "long", "image_id": "string", "category_id": "integer", "bbox": ArrayType(DoubleType()), "area": "double"})),
})
GEOJSON = fields({"crs": fields({"properties": fields({"name": "string"})}), "features": ArrayType(fields({"geometry": fields({"type": "string", "coordinates": "string"}), "properties": MapType(StringType(), StringType())}))})


RECORDING = fields({
    "data_path": "string",
    "frames": ArrayType(fields({"record_timestamp": "string", "image_file_timestamp": "string", "gps_data": fields({"latitude": "double", "longitude": "double", "coordinate_time_stamp": "string"})})),
})


def without(schema: StructType, *names: str) -> StructType:
    """The schema minus some fields: what a writer supplies when the table makes those itself."""
    return StructType([f for f in schema.fields if f.name not in names])


def flat_columns(schema: StructType, prefix: str = "") -> list[str]:
    """Dotted paths of all leaves of nested structs."""
    out: list[str] = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        out += flat_columns(f.dataType, f"{path}.") if isinstance(f.dataType, StructType) else [path]
    return out
